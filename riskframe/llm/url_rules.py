"""Bit-parallel wildcard automaton over canonical URLs.

All glob rules are packed into one row of 64-bit words, a bit per literal and one for the start of each rule. Reading
one character of a URL is a shift with carry, a mask of the rules' literals and a mask of the wildcards that stay; a
column of URLs goes through it together, character by character, so all rules and many URLs advance at once.

In a glob ``*`` is any run without ``/``, ``**`` any run, ``?`` one character other than ``/``.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from riskframe.llm.workers import ready

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class HostRule(NamedTuple):
    """Fits ``host`` and its subdomains where the path starts with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path

    def globs(self) -> list[str]:
        return [self.host + self.path + "**", "*." + self.host + self.path + "**"]


class GlobRule(NamedTuple):
    """Fits the whole canonical URL."""

    verdict: str
    glob: str


class GlobAutomaton:
    """Says which globs fit which strings."""

    def __init__(self, globs: Sequence[str]):
        slash = ord("/")
        literals: list[tuple[int, int | None]] = []  # (bit, byte or None for "?")
        loops: list[tuple[int, bool]] = []           # (bit, does "/" stay too)
        starts, ends, bit = [], [], 0
        for glob in globs:
            starts.append(bit)
            data, at = glob.encode(), 0
            while at < len(data):
                if data[at:at + 2] == b"**":
                    loops.append((bit, True))
                    at += 2
                elif data[at:at + 1] == b"*":
                    loops.append((bit, False))
                    at += 1
                else:
                    bit += 1
                    literals.append((bit, None if data[at:at + 1] == b"?" else data[at]))
                    at += 1
            ends.append(bit)
            bit += 1
        self.words = max(1, -(-bit // 64))
        self.step = np.zeros((256, self.words), np.uint64)
        self.stay = np.zeros((256, self.words), np.uint64)
        self.start = np.zeros(self.words, np.uint64)
        for b in starts:
            self.start[b // 64] |= np.uint64(1 << b % 64)
        other = [c for c in range(256) if c != slash]
        for b, byte in literals:
            self.step[other if byte is None else byte, b // 64] |= np.uint64(1 << b % 64)
        for b, with_slash in loops:
            self.stay[slice(None) if with_slash else other, b // 64] |= np.uint64(1 << b % 64)
        self.ends = np.array(ends, np.int64)

    def fits(self, data: bytes, offsets: np.ndarray) -> np.ndarray:
        """Matrix (strings x globs) for the strings ``data[offsets[i]:offsets[i + 1]]``."""
        text = np.frombuffer(data, np.uint8)
        lengths = np.diff(offsets)
        order = np.argsort(-lengths, kind="stable")
        begin, size = offsets[:-1][order], lengths[order]
        state = np.repeat(self.start[None, :], len(order), axis=0)
        one, top = np.uint64(1), np.uint64(63)
        active = np.searchsorted(-size, -np.arange(int(size[0]) if len(size) else 0), side="left")
        for column, n in enumerate(active.tolist()):  # the n longest strings still have a character here
            seen, now = text[begin[:n] + column], state[:n]
            moved = now << one
            moved[:, 1:] |= now[:, :-1] >> top
            state[:n] = (moved & self.step[seen]) | (now & self.stay[seen])
        found = np.empty((len(order), len(self.ends)), bool)
        found[order] = (state[:, self.ends // 64] >> (self.ends % 64).astype(np.uint64)) & one
        return found


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, url.substr(at + F.lit(3), F.length(url)))


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; empty without one."""
    host = F.regexp_extract(_after_scheme(url), "^([^/?#]*)", 1)
    return F.coalesce(F.translate(host, _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """From the host's end up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(_after_scheme(url), "^[^/?#]*([^?#]*)", 1), F.lit(""))


def judge_urls(pages: DataFrame, rules: Sequence[HostRule], globs: Sequence[GlobRule] = (), default: str = "allow",
               id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(page_id, host, path, rule, verdict, glob) of every row.

    The longest host rule that fits decides (of equally long ones the first); else the longest glob rule (``glob``
    names it); else ``default``. Rules are arguments, so their automaton has a fixed size. A url that is null, empty or
    lacks ``://`` has an empty host and path, which no host rule fits. Rows are independent: null and repeated ids,
    repeated rows and an empty table need no care, and a very long url is only read once.
    """
    ready(pages.sparkSession)
    rules, globs = list(rules), list(globs)
    pattern_rule = [at for at, rule in enumerate(rules) for _ in rule.globs()]
    patterns = [g for rule in rules for g in rule.globs()] + [g.glob for g in globs]

    def best(found: np.ndarray, sizes: list[int]) -> np.ndarray:
        """The longest fitting entry per row, -1 if none."""
        if not sizes:
            return np.full(len(found), -1)
        rank = np.array(sizes) * len(sizes) + np.arange(len(sizes))[::-1] + 1
        score = found * rank
        return np.where(score.max(axis=1, initial=0) > 0, score.argmax(axis=1), -1)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = GlobAutomaton(patterns)
        names = pa.array([r.name for r in rules], pa.string())
        said = [r.verdict for r in rules]
        for rows in batches:
            urls = [(h + p).encode() for h, p in zip(rows.column(1).to_pylist(), rows.column(2).to_pylist())]
            offsets = np.zeros(len(urls) + 1, np.int64)
            np.cumsum([len(u) for u in urls], out=offsets[1:])
            found = automaton.fits(b"".join(urls), offsets)
            by_rule = np.zeros((len(urls), len(rules)), bool)
            for column, at in enumerate(pattern_rule):
                by_rule[:, at] |= found[:, column]
            rule = best(by_rule, [len(r.name) for r in rules])
            glob = np.where(rule < 0, best(found[:, len(pattern_rule):], [len(g.glob) for g in globs]), -1)
            verdict = [said[r] if r >= 0 else globs[g].verdict if g >= 0 else default
                       for r, g in zip(rule.tolist(), glob.tolist())]
            yield pa.RecordBatch.from_arrays(
                [*rows.columns, names.take(pa.array(rule, mask=rule < 0)), pa.array(verdict, pa.string()),
                 pa.array([globs[g].glob if g >= 0 else None for g in glob.tolist()], pa.string())],
                names=["page_id", "host", "path", "rule", "verdict", "glob"])

    url = F.col("url")
    return (pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"))
            .select("page_id", host_of(url).alias("host"), path_of(url).alias("path"))
            .mapInArrow(judge, "page_id long, host string, path string, rule string, verdict string, glob string"))
