"""URL filter: glob rules simulated all at once by a bit-parallel wildcard automaton.

A rule's glob is a row of states, one bit each: a start and one per character
it consumes.  All rules lie side by side in as many 64-bit words as they need.
Reading byte c moves every rule at once (Shift-And with wildcards):

    D = ((D << 1) & ENTER[c]) | (D & STAY[c])

``ENTER[c]`` has the states that c leads into and ``STAY[c]`` those that a
wildcard lets c pass by; a shift carries from word to word and never enters a
rule's start.  A rule has matched if its last state is set at the end.

Globs run over canonical URLs: a dot, the host in lower case, the path; no
scheme, query or fragment.  ``*`` is any run of bytes but ``/``, ``**`` any
run, ``?`` one character but ``/``, and ``\\`` takes the next character as it
is.  The leading dot makes ``*.example.com/**`` fit the host and all its
subdomains but no other host that merely ends alike.

The automaton runs over Arrow batches of canonical URLs only, position by
position for all URLs of the batch; URLs that no rule can still change leave
the batch early, so long paths cost little where rules end in ``**``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barlake.llm.shared import col, lower_ascii

ALLOW, BLOCK = "allow", "block"
# State words of a batch held at a time, and positions between two looks for settled URLs.
WORDS_AT_ONCE = 1 << 20
LOOK = 8


@dataclass(frozen=True)
class Rule:
    """A glob with its verdict; of all rules that match, the one with the highest rank decides, then the first."""
    glob: str
    verdict: str
    name: str
    rank: int


def literal(text: str) -> str:
    """The glob that is exactly ``text``."""
    return "".join("\\" + c if c in "*?\\" else c for c in text)


def domain_rule(verdict: str, host: str, path: str) -> Rule:
    """A rule for a host with its subdomains and all paths that start with ``path``; the longest wins."""
    return Rule(f"*.{literal(host)}{literal(path)}**", verdict, host + path, len(host + path))


def glob_rule(verdict: str, glob: str) -> Rule:
    """A rule without a name that decides only where no domain rule does; block goes before allow."""
    return Rule(glob, verdict, "", -1 if verdict == BLOCK else -2)


class Automaton:
    """All rules packed into one multiword Shift-And automaton over bytes."""

    def __init__(self, rules: Sequence[Rule]):
        enter, stay = [], []  # per state: the bytes that lead into it, and that it lets pass
        self.starts, self.ends = [], []
        for r in rules:
            self.starts.append(len(enter))
            for into, passing in self.states(r.glob):
                enter.append(into)
                stay.append(passing)
            self.ends.append(len(enter) - 1)
        self.words = max(1, -(-len(enter) // 64))
        self.enter, self.stay = self.packed(enter), self.packed(stay)
        self.first = self.bits(self.starts)
        # settled: a last state that lets every byte pass, or a start that only waits
        self.settled = np.bitwise_and.reduce(self.stay, axis=0) & self.bits(self.ends)

    @staticmethod
    def states(glob: str) -> list[tuple[np.ndarray, np.ndarray]]:
        """(bytes that lead into the state, bytes that it lets pass), from the start on."""
        every, none = np.ones(256, dtype=bool), np.zeros(256, dtype=bool)
        segment = every.copy()
        segment[ord("/")] = False
        inside = none.copy()
        inside[0x80:0xC0] = True  # the further bytes of a UTF-8 character
        out = [(none, none)]
        at = 0
        while at < len(glob):
            c = glob[at]
            if c == "*":
                run = 2 if glob[at:at + 2] == "**" else 1
                into, passing = out[-1]
                out[-1] = into, passing | (every if run == 2 else segment)
                at += run
                continue
            if c == "?":
                out.append((segment & ~inside, inside))
            else:
                if c == "\\" and at + 1 < len(glob):
                    at += 1
                    c = glob[at]
                for byte in c.encode("utf-8"):
                    one = none.copy()
                    one[byte] = True
                    out.append((one, none))
            at += 1
        return out

    def bits(self, states: Sequence[int]) -> np.ndarray:
        out = np.zeros(self.words, dtype=np.uint64)
        for s in states:
            out[s >> 6] |= np.uint64(1 << (s & 63))
        return out

    def packed(self, sets: list[np.ndarray]) -> np.ndarray:
        """(byte, word) -> the states whose set holds the byte."""
        out = np.zeros((256, self.words), dtype=np.uint64)
        for s, members in enumerate(sets):
            out[members, s >> 6] |= np.uint64(1 << (s & 63))
        return out

    def match(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """(text, rule) -> whether the rule matches the whole text; texts lie in ``data`` at ``starts``."""
        out = np.empty((len(starts), len(self.ends)), dtype=bool)
        step = max(1, WORDS_AT_ONCE // (self.words + len(self.ends)))
        for a in range(0, len(starts), step):
            part = slice(a, a + step)
            out[part] = self._match(data, starts[part], lengths[part])
        return out

    def _match(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        final = np.zeros((len(starts), self.words), dtype=np.uint64)
        order = np.argsort(-lengths, kind="stable")  # the longest first: those that go on are always in front
        state = np.repeat(self.first[None, :], len(order), axis=0)
        begin, left = starts[order], lengths[order]
        one, top = np.uint64(1), np.uint64(63)
        at = 0
        while len(order):
            on = int(np.searchsorted(-left, -at, side="left"))  # texts longer than ``at``
            if on < len(order):
                final[order[on:]] = state[on:]
                order, state, begin, left = order[:on], state[:on], begin[:on], left[:on]
                continue
            c = data[begin + at]
            moved = state << one
            if self.words > 1:
                moved[:, 1:] |= state[:, :-1] >> top
            state = (moved & self.enter[c]) | (state & self.stay[c])
            at += 1
            if at % LOOK == 0:
                still = (state & ~self.settled).any(axis=1)
                if not still.all():
                    final[order[~still]] = state[~still]
                    order, state, begin, left = order[still], state[still], begin[still], left[still]
        ends = np.array(self.ends, dtype=np.int64)
        return (final[:, ends >> 6] >> (ends & 63).astype(np.uint64) & one).astype(bool)


@lru_cache(maxsize=4)
def automaton(rules: tuple[Rule, ...]) -> Automaton:
    """The worker's automaton of these rules, kept over batches and tasks."""
    return Automaton(rules)


def decide(urls: pa.Array, rules: tuple[Rule, ...]) -> np.ndarray:
    """Per canonical URL, the place in ``rules`` of the one that decides; -1 if none matches.  A null matches none."""
    found = np.full(len(urls), -1)
    if not rules or not len(urls):
        return found
    urls = urls.cast(pa.large_binary())
    known = urls.is_valid().to_numpy(zero_copy_only=False)
    whole = urls.drop_null() if urls.null_count else urls
    ends = np.frombuffer(whole.buffers()[1], dtype=np.int64)[whole.offset:whole.offset + len(whole) + 1]
    data = np.frombuffer(whole.buffers()[2] or b"", dtype=np.uint8)
    hits = automaton(rules).match(data, ends[:-1], np.diff(ends))
    best = np.full(len(hits), -1)
    for k in sorted(range(len(rules)), key=lambda k: (-rules[k].rank, k), reverse=True):  # the strongest last
        best[hits[:, k]] = k
    found[known] = best
    return found


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without one."""
    return lower_ascii(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    """From the host's end up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def judge(pages: DataFrame, rules: Sequence[Rule], default: str = ALLOW, id_col: str = "page_id",
          url_col: str = "url") -> DataFrame:
    """One row per row of ``pages``: the id, ``host``, ``path``, ``rule`` and ``verdict``.

    Of the rules that match a canonical URL the one with the highest rank
    decides, of equal ranks the first.  ``rule`` is its name, null if it has
    none or none matches; without a match the verdict is ``default``.  A null
    URL, or one without ``://``, has an empty host and path, and only globs
    that match a lone dot reach it.  Repeated rows get equal results, URLs of
    any length are read to where no rule can change any more, an empty table
    gives none.  Only the id and the URL are read; other columns do not matter.
    """
    rules = tuple(rules)
    rows = pages.select(col(id_col).alias("_id"), col(url_col).cast("string").alias("_url"))
    parts = rows.select("_id", host_of(F.col("_url")).alias("host"), path_of(F.col("_url")).alias("path"))

    @F.arrow_udf("int")
    def decides(urls: pa.Array) -> pa.Array:
        return pa.array(decide(urls, rules).astype(np.int32))

    judged = parts.withColumn("_k", decides(F.concat(F.lit("."), "host", "path")))
    names = F.array(*[F.lit(r.name or None).cast("string") for r in rules]).cast("array<string>")
    verdicts = F.array(*[F.lit(r.verdict) for r in rules]).cast("array<string>")
    return judged.select(
        F.col("_id").alias(id_col), "host", "path", F.get(names, F.col("_k")).alias("rule"),
        F.coalesce(F.get(verdicts, F.col("_k")), F.lit(default)).alias("verdict"))


def allowed(pages: DataFrame, rules: Sequence[Rule], default: str = ALLOW, url_col: str = "url") -> DataFrame:
    """The rows of ``pages`` that the rules allow, with all their columns."""
    rules = tuple(rules)
    blocked = [k for k, r in enumerate(rules) if r.verdict == BLOCK] + ([-1] if default == BLOCK else [])

    @F.arrow_udf("boolean")
    def passes(urls: pa.Array) -> pa.Array:
        return pa.array(~np.isin(decide(urls, rules), blocked))

    url = col(url_col).cast("string")
    return pages.where(passes(F.concat(F.lit("."), host_of(url), path_of(url))))


# The rules of the registered query.  Fixed values: the five domain rules.
DOMAIN_RULES = [(ALLOW, "com", "/"), (BLOCK, "example.com", "/en/"), (ALLOW, "www.example.com", "/en/"),
                (BLOCK, "net", "/es/"), (BLOCK, "net", "/fr/")]
# What decides elsewhere: hosts that say what they are, and pages that are no content.
GLOB_RULES = [(BLOCK, glob) for glob in (
    "*spam*/**", "*spam*", "*.cheap-pills.**", "*casino*/**", "*viagra*/**", "*.porn.**", "*.ads.**",
    "**/wp-login.php", "**/wp-admin/**", "**/cgi-bin/**", "**/xmlrpc.php", "**/cart/checkout**")]


def default_rules() -> list[Rule]:
    return [domain_rule(*r) for r in DOMAIN_RULES] + [glob_rule(*r) for r in GLOB_RULES]
