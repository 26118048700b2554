"""BPE encoding and decoding through a table of distinct words.

Tasks split texts into words and pack them into blocks: a list of a block's distinct words, and
for each word of its texts the place in that list. The lists of all blocks make one table of
distinct words, each with the blocks and places that it has. Each word is encoded once in it; its ids are joined
with the vocabulary's table of pieces, which decodes them. By those blocks and places, ids and texts
go back to the blocks, packed by task and block, and the places of the texts turn them into documents.
A word has at most one row for each block, so no key is hot and none needs to be broadcast.
"""

from __future__ import annotations

import functools
import hashlib
import json
import os
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltmesh.llm.shared import returned, settle_buckets

#: Characters of a block's texts from which it ends; one longer text is a block of its own.
BLOCK_CHARS = 32_000_000
#: Pieces of words that a task holds, at least, before it packs their words' ids and texts for the blocks: with places about 15 MB.
HELD = 100_000
#: A vocabulary with more pieces than this is not broadcast.
BROADCAST_PIECES = 2_000_000

#: How this family of vocabularies prepares and splits texts before its merges.
ENDINGS = "'s|'t|'re|'ve|'m|'ll|'d"
NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
PRE_TOKENIZERS = [
    {"type": "Split", "pattern": {"Regex": ENDINGS + r"|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
]

#: Characters whose normal form, case and class are the same in every version of Unicode in use;
#: dotted capital I is left out, since its lower case is two characters.
_PLAIN = "\x00-įı-ſ‐-‧€"


def _charset(kind: str) -> str:
    """The plain characters of a general category, as the inside of a character class."""
    return "".join(re.escape(chr(c)) for c in range(0x180) if unicodedata.category(chr(c))[0] == kind)


@functools.cache
def _patterns() -> tuple[re.Pattern, re.Pattern]:
    letter, number = _charset("L"), _charset("N")
    white = "\t\n\x0b\x0c\r \x85\xa0"
    return re.compile(f"[^{_PLAIN}]"), re.compile(f"{ENDINGS}|[{letter}]+|[{number}]|[^{white}{letter}{number}]+")


class Words:
    """Splits texts as a vocabulary file says, and encodes words. Files that split otherwise are refused."""

    def __init__(self, vocabulary: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        with open(vocabulary, encoding="utf-8") as f:
            rules = json.load(f)
        if (rules["normalizer"] or {}).get("normalizers") != NORMALIZERS or (rules["pre_tokenizer"] or {}).get("pretokenizers") != PRE_TOKENIZERS or rules["decoder"]:
            raise ValueError(f"{vocabulary} splits or decodes texts otherwise than by words")
        if any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in rules["added_tokens"]):
            raise ValueError(f"{vocabulary} has added tokens that are not matched as they stand")
        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.special = {t.content: i for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        self.cut = re.compile("(" + "|".join(re.escape(x) for x in sorted(self.special, key=len, reverse=True)) + ")") if self.special else None

    def split(self, text: str) -> list[str]:
        """The words of a text without special tokens."""
        odd, word = _patterns()
        if not odd.search(text):
            return word.findall(text.lower())
        text = self.tokenizer.normalizer.normalize_str(text)
        return [text[a:b] for _, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(text)]

    def of(self, text: str) -> list[str]:
        """All words of a text in order; strings of special tokens stay whole."""
        if self.cut is None or not self.cut.search(text):
            return self.split(text)
        out = []
        for part in self.cut.split(text):
            if part in self.special:
                out.append(part)
            elif part:
                out += self.split(part)
        return out

    def ids(self, words: list[str]) -> list[list[int]]:
        found = self.tokenizer.encode_batch(words, add_special_tokens=False)
        return [[self.special[w]] if w in self.special else e.ids for w, e in zip(words, found, strict=True)]


def _packed(places: np.ndarray) -> bytes:
    """Numbers as bytes, all first bytes before all second ones, compressed."""
    return zstandard.ZstdCompressor(level=1).compress(places.astype("<u4", copy=False).view(np.uint8).reshape(-1, 4).T.tobytes())


def _unpacked(packed: bytes, n: int) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(packed, max_output_size=4 * n), np.uint8).reshape(4, n).T.copy().view("<u4").ravel()


def word_blocks(docs: DataFrame, vocabulary: str, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(block, ids, sizes, places, words): the ids and numbers of words of a block's documents, the packed places of all its words in the list of its distinct ones, and that list.

    docs has the two columns id and text.
    """
    kind = docs.schema[0].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitter, nth = Words(vocabulary), 0

        def started() -> tuple:
            return [], [], [], {}

        ids, sizes, places, words = started()
        chars = 0

        def block() -> pa.RecordBatch:
            key = (TaskContext.get().partitionId() << 33) + nth
            flat = np.concatenate(places) if places else np.empty(0, np.uint32)
            return pa.RecordBatch.from_arrays(
                [pa.array([key], pa.int64()), _listed(pa.concat_arrays(ids)), _listed(pa.array(sizes, pa.int32())), pa.array([_packed(flat)], pa.binary()), _listed(pa.array(list(words), pa.string()))],
                names=["block", "ids", "sizes", "places", "words"],
            )

        for batch in batches:
            for i, text in enumerate(batch.column(1)):
                text = text.as_py() or ""
                found = splitter.of(text)
                places.append(np.fromiter((words.setdefault(w, len(words)) for w in found), np.uint32, len(found)))
                sizes.append(len(found))
                ids.append(batch.column(0).slice(i, 1))
                chars += len(text)
                if chars >= block_chars:
                    yield block()
                    (ids, sizes, places, words), chars, nth = started(), 0, nth + 1
                    returned()
        if ids:
            yield block()
        (ids, sizes, places, words), batch, splitter = started(), None, None
        returned()

    return docs.mapInArrow(run, f"block long, ids array<{kind.simpleString()}>, sizes array<int>, places binary, words array<string>")


def _listed(values: pa.Array) -> pa.Array:
    """One list of all values."""
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def encoded(words: DataFrame, vocabulary: str) -> DataFrame:
    """words (word, where) with the ids of each word, an array. A task has the vocabulary only while it encodes, as its worker goes on to others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitter = Words(vocabulary)
        for batch in batches:
            ids = pa.array(splitter.ids(batch.column(0).to_pylist()), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([*batch.columns, ids], names=["word", "where", "ids"])
        splitter = batch = ids = None
        returned()

    return words.select("word", "where").mapInArrow(run, f"word string, where {words.schema['where'].dataType.simpleString()}, ids array<int>")


def pieces(spark: SparkSession, vocabulary: str) -> DataFrame:
    """(id, piece) of a vocabulary."""
    tokenizer = Words(vocabulary).tokenizer
    found = [(i, x) for i in range(tokenizer.get_vocab_size(with_added_tokens=True)) if (x := tokenizer.id_to_token(i)) is not None]
    # From Arrow, as a list of rows would start Python workers of another kind on each executor, which stay.
    ids, texts = zip(*found, strict=True)
    return spark.createDataFrame(pa.table({"id": pa.array(ids, pa.int32()), "piece": pa.array(texts, pa.string())}), "id int, piece string")


def _known_pieces(spark: SparkSession, vocabulary: str) -> DataFrame:
    known = pieces(spark, vocabulary)
    return F.broadcast(known) if known.count() <= BROADCAST_PIECES else known


def decoded(table: DataFrame, vocabulary: str, key: str, ids: str = "ids", rest: tuple[str, ...] = ()) -> DataFrame:
    """(key, *rest, ids, text) of a table with unique keys and arrays of ids: the pieces of the ids with a space between, as the vocabulary has no decoder of its own.

    Each id is joined with the table of pieces and put back in its place; null and empty arrays, and unknown ids, give no text.
    A table that is dealt by key already is not shuffled.
    """
    known = _known_pieces(table.sparkSession, vocabulary)
    met = table.select(key, *rest, F.posexplode_outer(ids).alias("at", "id")).join(known, "id", "left")
    found = met.groupBy(key).agg(*(F.first(x).alias(x) for x in rest), F.array_sort(F.collect_list(F.when(F.col("id").isNotNull(), F.struct("at", "id", "piece")))).alias("_p"))
    return found.select(key, *rest, F.transform("_p", lambda x: x["id"]).alias(ids), F.array_join(F.transform("_p", lambda x: x["piece"]), " ").alias("text"))


def _gathered(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """(where, ids, text) of words from the rows (where, size, nth, id, piece) of their ids, which follow each other, at least so many rows at a time."""

    def words(rows: pa.Table) -> pa.RecordBatch:
        where, sizes, nth, id_, piece = (x.combine_chunks() for x in rows.columns)
        first, sizes = _begins(nth), sizes.to_numpy(zero_copy_only=False)
        # A word without ids has one row, of null.
        some = nth.is_valid()
        offsets = np.concatenate([[0], np.cumsum(np.maximum(sizes[first], 0))]).astype(np.int32)
        place = np.arange(offsets[-1]) - np.repeat(offsets[:-1], np.diff(offsets))
        if not np.array_equal(nth.filter(some).to_numpy(zero_copy_only=False), place) or piece.filter(some).null_count:
            raise RuntimeError("the ids of a word came apart, or one has no piece")
        lists = pa.ListArray.from_arrays(pa.array(offsets), id_.filter(some))
        texts = pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), piece.filter(some)), " ")
        return pa.RecordBatch.from_arrays([where.take(pa.array(first)), lists, texts], names=["where", "ids", "text"])

    parts, n = [], 0
    for batch in batches:
        parts.append(batch)
        n += batch.num_rows
        if n >= max(1, least):
            rows = pa.Table.from_batches(parts)
            cut = int(_begins(rows.column(2).combine_chunks()).max(initial=0))  # the last word may go on
            if cut:
                yield words(rows.slice(0, cut))
            parts = rows.slice(cut).to_batches()
            n -= cut
    if n:
        yield words(pa.Table.from_batches(parts))


def _begins(nth: pa.Array) -> np.ndarray:
    """Rows of the first ids of words, or of none."""
    return np.flatnonzero(pc.fill_null(nth, 0).to_numpy(zero_copy_only=False) == 0)


def _packed_words(words: pa.RecordBatch) -> Iterator[tuple]:
    """(block, n, at, sizes, ids, lengths, texts) for each block that some of the words (where, ids, text) are in, n of them."""
    where, ids, texts = words.columns
    spots = where.flatten()
    block, at = (spots.field(x).to_numpy(zero_copy_only=False) for x in ("block", "at"))
    word = np.repeat(np.arange(len(where)), pc.list_value_length(where).to_numpy(zero_copy_only=False))
    order = np.lexsort((at, block))
    block, at, word = block[order], at[order], word[order]
    edges = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1], [True]])) if len(block) else np.zeros(1, np.int64)
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        mine = pa.array(word[a:b])
        lists, said = ids.take(mine), texts.take(mine).cast(pa.large_binary())
        sizes, lengths = (pc.fill_null(f(x), 0).to_numpy(zero_copy_only=False) for f, x in ((pc.list_value_length, lists), (pc.binary_length, said)))
        data = zstandard.ZstdCompressor(level=1).compress(b"".join(said.to_pylist()))
        yield int(block[a]), b - a, _packed(at[a:b]), _packed(sizes), _packed(lists.flatten().to_numpy(zero_copy_only=False)), _packed(lengths), data


def _dealt(words: DataFrame, vocabulary: str, held: int, broadcast_pieces: int = BROADCAST_PIECES) -> DataFrame:
    """(block, n, at, sizes, ids, lengths, texts) of words (word, where, ids): what a task's words mean in one block, n of them, as packed columns.

    Each id is joined with the table of pieces. A broadcast table leaves the ids of a word one after the other, so that no
    shuffle is needed to gather them, and each word is tested for that; with a larger one they are gathered by word.
    """
    known = pieces(words.sparkSession, vocabulary)
    beside = known.count() <= broadcast_pieces
    if beside:
        rows = words.select("where", F.size("ids").alias("size"), F.posexplode_outer("ids").alias("nth", "id"))
        rows = rows.withColumn("where", F.when(F.coalesce("nth", F.lit(0)) == 0, F.col("where"))).join(F.broadcast(known), "id", "left").select("where", "size", "nth", "id", "piece")
    else:
        rows = decoded(words, vocabulary, "word", rest=("where",)).select("where", "ids", "text")
    names, kinds = ("block", "n", "at", "sizes", "ids", "lengths", "texts"), (pa.int64(), pa.int32(), *[pa.binary()] * 5)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found in _gathered(batches, held) if beside else batches:
            if made := list(_packed_words(found)):
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*made, strict=True), kinds, strict=True)], names=list(names))

    return rows.mapInArrow(run, "block long, n int, at binary, sizes binary, ids binary, lengths binary, texts binary")


def _meanings(found: pa.Array, n_words: int) -> tuple[list[bytes], list[bytes]]:
    """The ids and the text, as bytes, of each place of a block's list, from the packed columns of all tasks."""
    ids, texts = [b""] * n_words, [b""] * n_words
    for part in found.to_pylist():
        n = part["n"]
        at, sizes, lengths = (_unpacked(part[x], n) for x in ("at", "sizes", "lengths"))
        flat = _unpacked(part["ids"], int(sizes.sum(dtype=np.int64))).tobytes()
        data = zstandard.ZstdDecompressor().decompress(part["texts"], max_output_size=int(lengths.sum(dtype=np.int64)))
        i = j = 0
        for k, size, length in zip(at.tolist(), (4 * sizes.astype(np.int64)).tolist(), lengths.tolist(), strict=True):
            ids[k], texts[k] = flat[i : i + size], data[j : j + length]
            i, j = i + size, j + length
    return ids, texts


def encode_documents(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False, block_chars: int = BLOCK_CHARS, held: int = HELD) -> DataFrame:
    """Each row of docs to (id_col, n_tokens, ids_sha256, decoded_sha256[, ids]).

    One row for each input row, repeats included; a null text counts as empty and has no
    ids; texts are taken whole, also very long ones. An empty table gives no rows. Other columns are ignored, whatever their names. vocabulary
    is the path of a tokenizers file that every executor can read.
    """
    spark, kind = docs.sparkSession, docs.schema[id_col].dataType.simpleString()
    Words(vocabulary)
    n = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks = settle_buckets(word_blocks(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), vocabulary, block_chars), "bpe_blocks", n, "block")

    # Each distinct word once with its blocks and places, encoded, and decoded through the pieces of its ids.
    listed = blocks.select("block", F.posexplode("words").alias("at", "word")).repartition("word")
    known = listed.groupBy("word").agg(F.collect_list(F.struct("block", "at")).alias("where"))
    words = encoded(known, vocabulary)

    # Back to the blocks, each of which is one row with what all tasks have for it. They lie by block already and are not shuffled.
    found = _dealt(words, vocabulary, held).repartition(n, "block").groupBy("block").agg(F.collect_list(F.struct("n", "at", "sizes", "ids", "lengths", "texts")).alias("found"))
    whole = blocks.select("block", "ids", "sizes", "places", F.size("words").alias("n_words")).join(found, "block", "left")

    tail = [("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())] + [("tokens", pa.list_(pa.int32()))] * with_ids

    def assembled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                row = batch.slice(r, 1)
                ids, texts = _meanings(row.column("found").flatten(), row.column("n_words")[0].as_py())
                sizes = row.column("sizes").flatten().to_numpy()
                places = _unpacked(row.column("places")[0].as_py(), int(sizes.sum(dtype=np.int64)))
                names, end = row.column("ids").flatten(), 0
                for lo in range(0, len(sizes), 256):
                    n_tokens, sha, back, tokens = [], [], [], []
                    for size in sizes[lo : lo + 256].tolist():
                        mine = places[end : end + size].tolist()
                        end += size
                        raw = b"".join([ids[i] for i in mine])
                        n_tokens.append(len(raw) // 4)
                        sha.append(hashlib.sha256(raw).hexdigest())
                        back.append(hashlib.sha256(b" ".join([t for i in mine if (t := texts[i])])).hexdigest())
                        if with_ids:
                            tokens.append(np.frombuffer(raw, "<i4"))
                    columns = [n_tokens, sha, back, tokens] if with_ids else [n_tokens, sha, back]
                    yield pa.RecordBatch.from_arrays([names.slice(lo, 256), *(pa.array(x, t) for x, (_, t) in zip(columns, tail, strict=True))], names=["id", *(x for x, _ in tail)])
                row = ids = texts = places = None
                returned()

    out = whole.mapInArrow(assembled, f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", tokens array<int>" * with_ids)
    return out.select(F.col("id").alias(id_col), "n_tokens", "ids_sha256", "decoded_sha256", *([F.col("tokens").alias("ids")] if with_ids else []))
