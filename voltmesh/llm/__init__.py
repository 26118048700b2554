"""Operators for large training corpora; nothing else in voltmesh imports this subpackage."""
