"""License scans by conditional compression.

Blocks of text that speak of licences are compressed twice: alone, and with each template as
a raw zstandard dictionary. Templates that make no stretch of the block smaller go no further; the
others are ranked by how much smaller the block becomes, and each is confirmed by exact differences
of wording, in every place of the block that could hold it.
"""

from __future__ import annotations

import difflib
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltmesh.llm.wordings import TEMPLATES

HINT = r"(?i)licen[sc]|copyright|permission|redistribut|public domain|warrant|free software|unencumbered|misrepresent|original software|liab(?:le|ilit)|SPDX"
_SENTENCE = re.compile(r"(?<=[.!?:;])\s+|\n+")
#: A stretch that is compressed at once is so many times as long as a template's longest place, so that what the template saves in it stands out.
STRETCH = 3
#: Templates of fewer words are confirmed without a gain: so little may be saved in them that a few changed words use it up.
FEW = 12
_WORD = re.compile(r"[^\W_]+(?:[.-][^\W_]+)*")


def read_templates(folder: str | Path) -> dict[str, str]:
    """The files of a folder as templates by their names, for whole licences such as systems keep them."""
    return {p.name: p.read_text(encoding="utf-8", errors="replace") for p in sorted(Path(folder).iterdir()) if p.is_file()}


@dataclass(frozen=True)
class LicenseParams:
    """gap: sentences without a hint that may stand inside a block. missing: share of a
    template's words that the block may lack or change, and of words that it may add between them.
    """

    gap: int = 2
    missing: float = 0.1


def blocks(text: str, gap: int) -> Iterator[tuple[int, str]]:
    """(start, block) for each run of sentences with hints; short gaps are bridged."""
    hint = re.compile(HINT)
    begin = end = None
    idle = at = 0
    cuts = [(m.start(), m.end()) for m in _SENTENCE.finditer(text)] + [(len(text), len(text))]
    for stop, after in cuts:
        if hint.search(text, at, stop):
            begin, end, idle = at if begin is None else begin, stop, 0
        elif begin is not None:
            idle += 1
            if idle > gap:
                yield begin, text[begin:end]
                begin, idle = None, 0
        at = after
    if begin is not None:
        yield begin, text[begin:end]


class Scanner:
    """Compressors for each template, made once for a task."""

    def __init__(self, templates: dict[str, str], params: LicenseParams):
        import zstandard as zstd

        self.params, self.names = params, list(templates)
        self.words = {n: [w.lower() for w in _WORD.findall(t)] for n, t in templates.items()}
        self.counts = {n: Counter(w) for n, w in self.words.items()}
        self.alone = zstd.ZstdCompressor(level=3)
        given = lambda t: zstd.ZstdCompressor(level=3, dict_data=zstd.ZstdCompressionDict(t.encode(), dict_type=zstd.DICT_TYPE_RAWCONTENT))
        self.given = {n: given(t) for n, t in templates.items()}
        self.worded = {n: given(" ".join(w)) for n, w in self.words.items()}

    def differences(self, name: str, block: list[str]) -> tuple[int, int]:
        """Words of the template that the block lacks or changes, and words of the block beyond it between first and last match."""
        theirs = self.words[name]
        ops = difflib.SequenceMatcher(None, theirs, block, autojunk=False).get_opcodes()
        lost = sum(i2 - i1 for tag, i1, i2, _, _ in ops if tag in ("delete", "replace"))
        inner = [o for o in ops if 0 < o[1] < len(theirs) and o[0] in ("insert", "replace")]
        return lost, sum(j2 - j1 for _, _, _, j1, j2 in inner)

    def best(self, name: str, block: list[str], have: Counter) -> tuple[int, int, int] | None:
        """The least differences at any place of the block, whose words are counted in have, within the bounds, and that place; or None.

        Of a template of n words at most m = missing * n may be lost, and as many added, so one
        of its first m + 1 words stands in its place and begins it. From each such word of the
        block, a window of n + 2m words holds all the rest.
        """
        theirs = self.words[name]
        n = len(theirs)
        most = int(self.params.missing * n)
        heads: dict[str, int] = {}
        for i, w in enumerate(theirs[: most + 1]):
            heads.setdefault(w, i)
        need = self.counts[name]
        if sum(min(k, have.get(w, 0)) for w, k in need.items()) < n - most:
            return None
        out = None
        for at in (j for j, w in enumerate(block) if w in heads):
            # Too few words in common leave no alignment.
            window = block[at : at + n + 2 * most]
            if sum((need & Counter(window)).values()) < n - most:
                continue
            for end in sorted({len(window), min(len(window), n)}):
                lost, added = self.differences(name, window[:end])
                if lost <= most and added <= most and (out is None or (lost + added, lost) < (out[0] + out[1], out[0])):
                    out = lost, added, at
            if out is not None and out[:2] == (0, 0):
                break
        return out

    def exact(self, name: str, block: list[str]) -> Iterator[tuple[int, int]]:
        """From and to of each place where the template stands word for word."""
        theirs = self.words[name]
        for at, w in enumerate(block):
            if w == theirs[0] and block[at : at + len(theirs)] == theirs:
                yield at, at + len(theirs)

    def gaining(self, block: list[str]) -> list[str]:
        """The templates whose words make some stretch of the block's words smaller, and those too short to tell. Each place that could hold a template lies whole in a stretch."""
        alone: dict[bytes, int] = {}

        def gains(name: str) -> bool:
            n = len(self.words[name])
            reach = n + 2 * int(self.params.missing * n)
            for at in range(0, max(1, len(block) - reach), (STRETCH - 1) * reach):
                raw = " ".join(block[at : at + STRETCH * reach]).encode()
                if raw not in alone:
                    alone[raw] = len(self.alone.compress(raw))
                if len(self.worded[name].compress(raw)) < alone[raw]:
                    return True
            return False

        return [n for n in self.names if len(self.words[n]) < FEW or gains(n)]

    def confirmed(self, block: list[str], names: list[str]) -> dict[str, tuple[int, int]]:
        """Words missing and added of each of the named templates that the block holds. Where one stands word for word, others like it are not found with differences."""
        have, out = Counter(block), {}
        first = {n: x for n in names if (x := self.best(n, block, have)) is not None}
        places = {n: list(self.exact(n, block)) for n, x in first.items() if x[:2] == (0, 0)}
        for name, found in first.items():
            left, n = list(block), len(self.words[name])
            while found is not None and found[:2] != (0, 0):
                lost, added, at = found
                over = [p for o, at_ in places.items() for p in at_ if p[0] < at + n + added and at < p[1] and 10 * len(self.words[o]) >= 9 * n and left[p[0]] is not None]
                if not over:
                    break
                for a, b in over:
                    left[a:b] = [None] * (b - a)
                found = self.best(name, left, Counter(left))
            if found is not None:
                out[name] = found[:2]
        return out

    def scan(self, text: str) -> list[tuple[int, str, float, int, int]]:
        """(start of block, template, gain, words missing, words added) of the confirmed templates of each block, best first."""
        out = []
        for start, block in blocks(text, self.params.gap):
            raw = block.encode()
            size = len(self.alone.compress(raw))
            words = [w.lower() for w in _WORD.findall(block)]
            here = [(round(1 - len(self.given[n].compress(raw)) / size, 6), n, *apart) for n, apart in self.confirmed(words, self.gaining(words)).items()]
            out += [(start, name, gain, *apart) for gain, name, *apart in sorted(here, key=lambda x: (-x[0], x[1]))]
        return out


def find_licenses(docs: DataFrame, templates: dict[str, str] = TEMPLATES, params: LicenseParams = LicenseParams()) -> DataFrame:
    """doc_id and found, an array of (start, license, gain, missing, added), for each row of docs.

    One row for each input row; texts that are null, empty or without a hint have an empty array. Long texts are scanned
    block by block, whole. A licence that stands twice in a block is found once there; an empty table gives no rows.
    Ties between templates go to the name that sorts first. Spark's expressions keep texts
    without a hint from leaving the JVM; other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates, params)
        kind = pa.list_(pa.struct([("start", pa.int32()), ("license", pa.string()), ("gain", pa.float64()), ("missing", pa.int32()), ("added", pa.int32())]))
        for batch in batches:
            found = [[dict(zip(("start", "license", "gain", "missing", "added"), x, strict=True)) for x in scanner.scan(t.as_py())] if t.is_valid else [] for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, kind)], names=["doc_id", "found"])

    rows = docs.select("doc_id", F.when(F.col("text").rlike(HINT), F.col("text")).alias("text"))
    return rows.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, found array<struct<start:int,license:string,gain:double,missing:int,added:int>>")


def license_report(found: DataFrame) -> DataFrame:
    """doc_id, n_found, the distinct licences sorted and comma-joined, and the words in which they differ from their templates."""
    names = F.array_sort(F.array_distinct(F.transform("found", lambda x: x["license"])))
    apart = F.aggregate("found", F.lit(0).cast("long"), lambda a, x: a + x["missing"] + x["added"])
    return found.select("doc_id", F.size("found").cast("long").alias("n_found"), F.array_join(names, ",").alias("licenses"), apart.alias("words_apart"))
