"""Secret scans through a trigram index.

From each rule's regular expression a Boolean query over trigrams is derived: a
concatenation needs what any of its parts needs, an alternation what one of its
branches needs, a repeat what its body needs when it occurs at least once.
Short literal sets are carried exactly, so trigrams that span the parts of a
pattern count too. Each batch of documents is one shard of an inverted index
over the trigrams that any rule asks for (posting list: the positions of the
texts that hold it), built in one pass over the texts' trigrams; a rule's query is answered by intersecting and uniting
postings, and only candidate texts meet its regular expression. A rule whose
query is empty (no mandatory trigram) scans every text. Index, queries and texts
use ASCII lower case, so a case-sensitive rule may get more candidates, never
fewer. Shards need no shuffle, and no text leaves its task.

Defined cases: null text is empty and has no span; very long texts are indexed in
chunks and searched whole; spans that start together are in the order of the
rules; repeated rows and null ids are rows of their own; an empty table gives an empty result; other columns of
the input are ignored.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass
from functools import cache, cached_property
from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches

try:
    from re import _constants as _c
    from re import _parser
except ImportError:  # older interpreters
    import sre_constants as _c
    import sre_parse as _parser

#: Strings that a literal set may hold before it is turned into a query.
MOST_EXACT = 64
#: Bytes of texts that are turned into trigrams at once.
CHUNK = 1 << 20
#: Members that a character class may have and still count as literals.
MOST_CLASS = 8


@dataclass(frozen=True)
class Rule:
    """``least`` is the fewest characters of group ``group``; other matches are dropped."""

    name: str
    pattern: str
    least: int = 0
    group: int = 0
    ignore_case: bool = False

    @cached_property
    def regex(self) -> re.Pattern:
        return re.compile(self.pattern, re.ASCII | (re.IGNORECASE if self.ignore_case else 0))

    def spans(self, text: str) -> list[tuple[int, int]]:
        """Leftmost non-overlapping matches (start, end), without those that are too short."""
        return [m.span() for m in self.regex.finditer(text) if len(m[self.group]) >= self.least]


#: The base rules, in their order.
BASE = (
    Rule("assign", r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 6, 2, True),
    Rule("access", r"AKIA[A-Z0-9]+", 20),
    Rule("hex", r"[0-9a-f]+", 24),
)
#: Public credential formats, which add spans.
MORE = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("gitlab", r"glpat-[A-Za-z0-9_-]{20,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("stripe", r"[rs]k_live_[A-Za-z0-9]{16,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]+"),
    Rule("private", r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----"),
    Rule("url", r"[a-z][a-z0-9+.-]*://[^\s/:@]+:[^\s/:@]+@[^\s/:@]+"),
)

# --- queries: ("all",), ("tri", t), ("and", parts), ("or", parts) ---

ALL = ("all",)


def _and(parts) -> tuple:
    flat = {x for p in parts for x in (p[1] if p[0] == "and" else [p]) if x != ALL}
    return ALL if not flat else next(iter(flat)) if len(flat) == 1 else ("and", tuple(sorted(flat, key=repr)))


def _or(parts) -> tuple:
    flat = {x for p in parts for x in (p[1] if p[0] == "or" else [p])}
    return ALL if ALL in flat or not flat else next(iter(flat)) if len(flat) == 1 else ("or", tuple(sorted(flat, key=repr)))


def _of_strings(strings) -> tuple:
    return _or([_and([("tri", s[i : i + 3]) for i in range(len(s) - 2)]) for s in strings])


def _members(items) -> set[str] | None:
    """The characters of a class in lower case; None if they are many or negated."""
    out: set[str] = set()
    for op, arg in items:
        if op is _c.LITERAL:
            out.add(chr(arg).lower())
        elif op is _c.RANGE and arg[1] - arg[0] < 64:
            out |= {chr(x).lower() for x in range(arg[0], arg[1] + 1)}
        else:
            return None
        if len(out) > MOST_CLASS:
            return None
    return out


def _analyse(items) -> tuple[set[str] | None, tuple]:
    """(the exact strings if few, else None; what any match needs besides)."""
    needs, run, whole = [], {""}, True

    def close() -> None:
        nonlocal run, whole
        needs.append(_of_strings(run))
        run, whole = {""}, False

    for op, arg in items:
        if op is _c.LITERAL:
            exact, need = {chr(arg).lower()}, ALL
        elif op is _c.IN:
            exact, need = _members(arg), ALL
        elif op is _c.SUBPATTERN:
            exact, need = _analyse(arg[-1])
        elif op is _c.BRANCH:
            found = [_analyse(x) for x in arg[1]]
            exact = set().union(*[e for e, _ in found]) if all(e is not None for e, _ in found) else None
            need = ALL if exact is not None else _or([_of_strings(e) if e is not None else n for e, n in found])
        elif op in (_c.MAX_REPEAT, _c.MIN_REPEAT):
            low, high, body = arg
            exact, need = _analyse(body)
            if low == 0 and high == 1 and exact is not None:
                exact = exact | {""}
            elif low == high == 1 or exact is not None and low == high and len(exact) ** low <= MOST_EXACT:
                exact = exact and {"".join(x) for x in product(sorted(exact), repeat=low)}
            elif low == 0:
                exact, need = None, ALL
            else:
                need = _and([need, _of_strings(exact)]) if exact is not None else need
                exact = None
        elif op is _c.AT:
            continue
        else:
            exact, need = None, ALL
        needs.append(need)
        if exact is None:
            close()
        elif len(run) * len(exact) > MOST_EXACT:
            close()
            run = exact
        else:
            run = {a + b for a in run for b in exact}
    if whole:
        return run, ALL
    close()
    return None, _and(needs)


def query_of(rule: Rule) -> tuple:
    """The Boolean trigram query that any match of the rule satisfies."""
    exact, need = _analyse(_parser.parse(rule.pattern))
    return _of_strings(exact) if exact is not None else need


def trigrams(query: tuple) -> set[str]:
    return {query[1]} if query[0] == "tri" else set().union(*map(trigrams, query[1])) if len(query) > 1 else set()


@cache
def _lookup(vocabulary: tuple[str, ...]) -> np.ndarray:
    """For each three bytes the number, from 1 on, of the trigram that they are."""
    table = np.zeros(1 << 24, np.uint16)
    for i, tri in enumerate(vocabulary):
        a, b, c = tri.encode()
        table[a << 16 | b << 8 | c] = i + 1
    return table


class TrigramIndex:
    """An inverted index over one batch of texts, restricted to ``vocabulary``; ``searched`` counts the texts that ``find`` named, of ``asked``."""

    def __init__(self, texts: list[str], vocabulary: set[str]):
        self.n, self.searched, self.asked = len(texts), 0, 0
        self.postings: dict[str, set[int]] = {tri: set() for tri in vocabulary}
        plain = tuple(sorted(t for t in vocabulary if t.isascii() and "\0" not in t))
        blobs = [t.encode("utf-8", "surrogatepass").lower() for t in texts]  # bytes: A-Z only
        for tri in vocabulary.difference(plain):  # of several bytes a character: searched for
            key = tri.encode("utf-8", "surrogatepass")
            self.postings[tri] = {i for i, b in enumerate(blobs) if key in b}
        if not plain:
            return
        # one pass over all the texts' trigrams; zero bytes part the texts, and no trigram has one
        data = np.frombuffer(b"\0\0".join([*blobs, b""]), np.uint8)
        starts = np.cumsum([0, *[len(b) + 2 for b in blobs]])
        table = _lookup(plain)
        for at in range(0, len(data) - 2, CHUNK):
            part = data[at : at + CHUNK + 2].astype(np.uint32)
            number = table[part[:-2] << 16 | part[1:-1] << 8 | part[2:]]
            where = np.flatnonzero(number)
            text = np.searchsorted(starts, where + at, "right") - 1
            for pair in np.unique(text * (len(plain) + 1) + number[where]).tolist():
                i, k = divmod(pair, len(plain) + 1)
                self.postings[plain[k - 1]].add(i)

    def candidates(self, query: tuple) -> set[int] | range:
        """``find``, counted."""
        found = self.find(query)
        self.searched, self.asked = self.searched + len(found), self.asked + self.n
        return found

    def find(self, query: tuple) -> set[int] | range:
        """Positions of the texts that satisfy the query; all of them for the empty one."""
        if query == ALL:
            return range(self.n)
        if query[0] == "tri":
            return self.postings[query[1]]
        parts = sorted((self.find(q) for q in query[1]), key=len)
        return parts[0].intersection(*parts[1:]) if query[0] == "and" else set().union(*parts)


def scan_texts(texts: list[str], rules: tuple[Rule, ...], index: TrigramIndex | None = None) -> list[list[tuple[str, int, int]]]:
    """For each text its spans (rule, start, end) by start, then in the order of the rules."""
    queries = [query_of(r) for r in rules]
    index = index or TrigramIndex(texts, set().union(*map(trigrams, queries)))
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for k, (rule, query) in enumerate(zip(rules, queries, strict=True)):
        for i in index.candidates(query):
            found[i] += [(a, k, b) for a, b in rule.spans(texts[i])]
    return [[(rules[k].name, a, b) for a, k, b in sorted(x)] for x in found]


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = BASE + MORE) -> DataFrame:
    """One row per row of ``docs``: id, spans (array of kind, start, end; code points, end exclusive)."""

    @F.pandas_udf("array<struct<kind string, start int, end int>>")
    def spans(texts: pd.Series) -> pd.Series:
        return pd.Series([[{"kind": k, "start": a, "end": b} for k, a, b in x] for x in scan_texts(texts.tolist(), rules)], dtype=object)

    return small_batches(docs).select(F.col(id_col), spans(F.coalesce(F.col(text_col), F.lit(""))).alias("spans"))


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The digest columns: counts of base spans, the SHA-256 of their list, all spans as a string."""
    names = [r.name for r in BASE]
    base = F.filter("spans", lambda s: s["kind"].isin(names))
    listed = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda name: F.size(F.filter("spans", lambda s: s["kind"] == name)).cast("long")
    return found.select(id_col, *[count(n).alias(f"n_{n}") for n in names], F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))
