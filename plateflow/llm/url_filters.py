"""URL filters by a bit-parallel wildcard automaton.

Every rule becomes glob patterns over the canonical url (host, lower-cased, and path). All
patterns are packed, one bit a position, into the words of Shift-And masks, and all advance
together over each url: ``state = (state << 1) & match[byte] | state & stay[byte]``, where
``stay`` holds the positions after a wildcard. A batch of urls is simulated side by side.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, functions as F

from plateflow.llm.frames import append, column, kept

ALLOW, BLOCK = "allow", "block"
SLASH = ord("/")


@dataclass(frozen=True)
class Rule:
    """``host`` with all subdomains, where the path starts with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path

    def globs(self) -> list[str]:
        """Patterns over host + path: ``*`` in the host part stays within the host, a last ``*`` is anything."""
        return [f"{self.host}{self.path}*", f"*.{self.host}{self.path}*"]


#: The published rule list.
RULES = (
    Rule(BLOCK, "net", "/"),
    Rule(ALLOW, "example.net", "/en/"),
    Rule(BLOCK, "example.com", "/de/"),
    Rule(ALLOW, "org", "/fr/"),
)


class Automaton:
    """Packed Shift-And masks of many glob patterns; any number of 64-bit words.

    A leading or inner ``*`` before the first slash matches any bytes but a slash; a ``*`` after
    it matches any bytes. ``fits[:, i]`` tells whether pattern i matches the whole url.
    """

    def __init__(self, globs: Sequence[str]) -> None:
        plans = []  # (bytes, per position: None, "host" or "any" for its loop)
        for glob in globs:
            data, loops = bytearray(), [None]
            for byte in glob.encode("utf-8"):
                if byte == ord("*"):
                    loops[-1] = "any" if SLASH in data else "host"
                else:
                    data.append(byte)
                    loops.append(None)
            plans.append((bytes(data), loops))
        bits = sum(len(loops) for _, loops in plans)
        self.words = max(1, -(-bits // 64))
        self.match = np.zeros((256, self.words), np.uint64)
        self.stay = np.zeros((256, self.words), np.uint64)
        self.start = np.zeros(self.words, np.uint64)
        self.final: list[tuple[int, np.uint64]] = []
        at = 0
        for data, loops in plans:
            for i, loop in enumerate(loops):
                word, bit = (at + i) // 64, np.uint64(1 << ((at + i) % 64))
                if i == 0:
                    self.start[word] |= bit
                else:
                    self.match[data[i - 1], word] |= bit
                if loop:
                    self.stay[:, word] |= bit
                    if loop == "host":
                        self.stay[SLASH, word] &= ~bit
            end = at + len(loops) - 1
            self.final.append((end // 64, np.uint64(1 << (end % 64))))
            at += len(loops)

    def fits(self, urls: Sequence[bytes]) -> np.ndarray:
        """(urls, patterns) booleans."""
        lengths = np.fromiter(map(len, urls), np.int64, len(urls))
        order = np.argsort(-lengths, kind="stable")
        data = np.frombuffer(b"".join(urls), np.uint8)
        begins = (np.cumsum(lengths) - lengths)[order]
        lengths = lengths[order]
        state = np.tile(self.start, (len(urls), 1))
        step = 0
        while len(lengths) and (running := int(np.searchsorted(-lengths, -step, "left"))):
            byte = data[begins[:running] + step]
            old = state[:running]
            moved = old << np.uint64(1)
            moved[:, 1:] |= old[:, :-1] >> np.uint64(63)
            state[:running] = (moved & self.match[byte]) | (old & self.stay[byte])
            step += 1
        out = np.zeros((len(urls), len(self.final)), bool)
        for i, (word, bit) in enumerate(self.final):
            out[order, i] = (state[:, word] & bit) != 0
        return out


def judge(pages: DataFrame, rules: Sequence[Rule] = RULES, otherwise: str = ALLOW, url: str = "url",
          keep: Sequence[str] = ("page_id",)) -> DataFrame:
    """The ``keep`` columns, ``host``, ``path``, ``rule`` (like ``net/``; null if none fits) and ``verdict``.

    Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased. Path: from
    there up to ``?``, ``#`` or the end. Both are empty for a null url or one without ``://``.
    Of the rules that fit, the longest wins (then the longer host, then block before allow).
    Urls of any length are judged whole; repeated rows each have a verdict; an empty table gives
    an empty result; kept columns named like an output are replaced by it. The rules are part of
    the job's code, so their number does not follow the data.
    """
    if otherwise not in (ALLOW, BLOCK):
        raise ValueError("otherwise must be allow or block")
    ranked = sorted(rules, key=lambda r: (-len(r.name), -len(r.host), r.verdict != BLOCK, r.name))
    globs = [g for r in ranked for g in r.globs()]
    outputs = ("host", "path", "rule", "verdict")
    value = F.coalesce(column(pages, url), F.lit(""))
    mark = F.instr(value, "://")
    from_host = F.when(mark > 0, F.substr(value, mark + 3)).otherwise(F.lit(""))
    carry = kept(keep, outputs)
    split = pages.select(
        *[column(pages, c).alias(f"c{i}") for i, c in enumerate(carry)], from_host.alias("rest"))
    host = F.translate(F.regexp_extract("rest", "^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    split = split.select(*[f"c{i}" for i in range(len(carry))], host.alias("host"),
                         F.regexp_extract("rest", "^[^/?#]*([^?#]*)", 1).alias("path"))

    def make():
        automaton = Automaton(globs)

        def compute(columns):
            hosts, paths = columns
            fits = automaton.fits([(h + p).encode("utf-8") for h, p in zip(hosts.to_pylist(), paths.to_pylist(), strict=True)])
            by_rule = fits[:, 0::2] | fits[:, 1::2]
            found = by_rule.any(axis=1)
            best = by_rule.argmax(axis=1)
            return ([ranked[b].name if f else None for b, f in zip(best, found, strict=True)],
                    [ranked[b].verdict if f else otherwise for b, f in zip(best, found, strict=True)])

        return compute

    judged = append(split, ["host", "path"], "rule string, verdict string", make,
                    keep=[f"c{i}" for i in range(len(carry))] + ["host", "path"])
    return judged.toDF(*carry, *outputs)
