"""URL filters by a bit-parallel wildcard automaton.

Globs over the canonical URL (host in lower case, then path) are packed side by side into 64-bit words, one bit for
each prefix of each glob. Reading one character moves all globs at once: state = (state << 1 with carries) & reach of
the character, or state & stay of the character. `*` stays on any character but `/`, `**` on any, `?` is one character.
All URLs of a batch are lanes that step together, the longest first, so memory is states times URLs.

A rule (host, path) fits the host and its subdomains, where the URL's path starts with its own; it becomes two globs.
The longest fitting rule decides, the earlier of equal ones (of equal ones in a table: the first by host, path and
verdict); otherwise a URL that any blocked glob matches is blocked. Rules and globs may be given as tables; they go to
every task, so that tables of more than MAX_BITS characters together are refused, not cut. Null rows of such tables are
left out. Null URLs and those without :// have an empty host and path and are allowed unless a glob matches the empty
string.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.cluster import ship
from tickloom.llm import scan

_U = np.uint64
MAX_BITS = 1 << 18
RULES = (("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block"))
#: Words of hosts that sell, bet or track.
BLOCKED = ("*casino**", "*-bets**", "*pills**", "ads-**", "*.ads-**", "*porn**", "*xxx**")


class Automaton:
    """Globs as masks. tokens of a glob: (byte or None for any one character, wildcard before it)."""

    def __init__(self, globs: list[str]):
        start, self.final, steps, stays = 0, [], [], {}
        self.begins = []
        for glob in globs:
            pos, state, raw = 0, start, glob.encode()
            self.begins.append(start)
            while pos < len(raw):
                if raw[pos : pos + 1] == b"*":
                    far = raw[pos : pos + 2] == b"**"
                    stays[state] = stays.get(state, False) or far
                    pos += 1 + far
                else:
                    steps.append((state + 1, None if raw[pos : pos + 1] == b"?" else raw[pos]))
                    state, pos = state + 1, pos + 1
            self.final.append(state)
            start = state + 1
        self.n_words = max(1, -(-start // 64))
        self.reach, self.stay = np.zeros((256, self.n_words), np.uint64), np.zeros((256, self.n_words), np.uint64)
        for state, byte in steps:
            self.reach[slice(None) if byte is None else byte, state // 64] |= _U(1 << state % 64)
        for state, far in stays.items():
            self.stay[:, state // 64] |= _U(1 << state % 64)
            if not far:
                self.stay[ord("/"), state // 64] &= ~_U(1 << state % 64)

    def matches(self, raw: np.ndarray, offs: np.ndarray) -> np.ndarray:
        """One row a URL, one column a glob."""
        size = np.diff(offs)
        order = np.argsort(-size, kind="stable")
        size, at = size[order], offs[:-1][order]
        state = np.zeros((len(order), self.n_words), np.uint64)
        for s in self.begins:
            state[:, s // 64] |= _U(1 << s % 64)
        live = len(order)
        for j in range(int(size[0]) if len(size) else 0):
            live = int(np.searchsorted(-size[:live], -j, "left"))
            now, c = state[:live], raw[at[:live] + j]
            moved = now << _U(1)
            if self.n_words > 1:
                moved[:, 1:] |= now[:, :-1] >> _U(63)
            state[:live] = (moved & self.reach[c]) | (now & self.stay[c])
        out = np.zeros((len(order), len(self.final)), bool)
        for i, s in enumerate(self.final):
            out[order, i] = (state[:, s // 64] >> _U(s % 64)) & _U(1) != 0
        return out


def _judge_rows(rules: tuple[tuple[str, str, str], ...], blocked: tuple[str, ...]):
    """Columns id, host, path."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        globs = [g for host, path, _ in rules for g in (f"{host}{path}**", f"*.{host}{path}**")]
        machine = Automaton([*globs, *blocked])
        size = np.array([len(h) + len(p) for h, p, _ in rules])
        order = np.argsort(-size, kind="stable")
        names = np.array([h + p for h, p, _ in rules], object)
        for batch in batches:
            url = pa.compute.binary_join_element_wise(batch.column(1), batch.column(2), "")
            for block in scan.blocks(url):
                hit = machine.matches(block.raw, block.offs)
                fits = (hit[:, 0 : len(globs) : 2] | hit[:, 1 : len(globs) : 2])[:, order]
                best = order[fits.argmax(1)] if len(rules) else np.zeros(block.n, int)
                some = fits.any(1)
                rule = [names[i] if ok else None for i, ok in zip(best.tolist(), some.tolist(), strict=True)]
                bad = hit[:, len(globs) :].any(1).tolist()
                verdict = [rules[i][2] if ok else "block" if b else "allow" for i, ok, b in zip(best.tolist(), some.tolist(), bad, strict=True)]
                front = [batch.column(c).slice(block.first, block.n) for c in range(3)]
                yield pa.RecordBatch.from_arrays([*front, pa.array(rule, pa.string()), pa.array(verdict, pa.string())], ["page_id", "host", "path", "rule", "verdict"])

    return run


def _rows_of(table: DataFrame, columns: list[str]) -> list[tuple]:
    """The distinct rows of a table of rules in order, after its size is asked."""
    rows = table.select(*[F.col(c).cast("string").alias(c) for c in columns]).dropna().distinct()
    size = rows.agg(F.sum(sum(F.length(c) + 1 for c in columns))).first()[0] or 0
    if size > MAX_BITS:
        raise ValueError(f"{size} characters of rules are more than {MAX_BITS}")
    return sorted(map(tuple, rows.collect()))


def judged(pages: DataFrame, rules: Sequence[tuple[str, str, str]] | DataFrame = RULES, blocked: Sequence[str] | DataFrame = BLOCKED, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """page_id, host, path, rule and verdict of every row of pages. rules: (host, path, verdict), or a table with these
    columns; blocked: globs, or a table with the column glob."""
    ship(pages.sparkSession)
    if isinstance(rules, DataFrame):
        rules = _rows_of(rules, ["host", "path", "verdict"])
    if isinstance(blocked, DataFrame):
        blocked = [g for (g,) in _rows_of(blocked, ["glob"])]
    part = lambda i: F.coalesce(F.regexp_extract(F.col(url_col), "(?s)^.*?://([^/?#]*)([^?#]*)", i), F.lit(""))
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.translate(part(1), upper, lower).alias("host"), part(2).alias("path"))
    return rows.mapInArrow(_judge_rows(tuple(rules), tuple(blocked)), "page_id long, host string, path string, rule string, verdict string")
