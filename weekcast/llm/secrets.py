"""Secret scan over a trigram inverted index.

For every rule a Boolean query over byte trigrams is derived from the regular expression: whatever text the
rule matches holds these trigrams (literals, small character classes, options and branches are
followed; letter case is folded).  Each block of documents (about 2 MB of text in one task) gets an
inverted index of the queried trigrams: a sorted posting list of rows for each.  The queries are evaluated by
intersecting and uniting postings, and only the documents that are left are verified with the
regular expression.  A rule without a mandatory trigram (a long run of hex digits, say) scans every document.
Postings never cross documents, so blocks need no shuffle, and a lost task repeats its blocks alone.
``build_index`` returns the postings as a table, for rule sets that are tried again and again.

A match that is shorter than its rule's ``min_chars`` is dropped, and the search goes on behind it.

Edge cases: a null or empty text has no spans; repeated rows are scanned one by one; offsets are
code points, end exclusive; an empty table gives an empty result.
"""

from __future__ import annotations

import re
import re._constants as _c
import re._parser as _parser
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import documents, pieces, utf8
from .registry import query


@dataclass(frozen=True)
class Rule:
    """``group``: the part of the match that needs ``min_chars`` characters.

    ``scan`` is a pattern with the same matches and others, without its group 1, that are none.  It is for patterns that would
    read a run of characters again from each place in it: such a place can't match where the first one in the run doesn't.
    """

    kind: str
    pattern: str
    min_chars: int = 1
    group: int = 0
    scan: str | None = None

    def compiled(self) -> re.Pattern:
        return re.compile(self.scan or self.pattern, re.ASCII)


_ASSIGN = r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
_KEYWORDS = "password|passwd|secret|token|api_?key"

BASE_RULES = (
    Rule("assign", f"((?i:{_KEYWORDS})){_ASSIGN}", 6, 2),
    Rule("access", "AKIA[A-Z0-9]+", 20),
    Rule("hex", "[0-9a-f]+", 24),
)

RULES = (
    *BASE_RULES,
    Rule("private_key", "-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("forge_token", "gh[pousr]_[A-Za-z0-9]+", 40),
    Rule("chat_token", "xox[abprs]-[A-Za-z0-9-]+", 20),
    Rule("cloud_key", "AIza[A-Za-z0-9_-]+", 39),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 30, scan=r"eyJ[A-Za-z0-9_-]++(\.eyJ[A-Za-z0-9_-]++\.[A-Za-z0-9_-]++)?"),
    Rule("payment_key", "[rs]k_live_[A-Za-z0-9]+", 24),
)

#: A query is None (any text may match) or a frozenset of alternatives, each a frozenset of trigrams that
#: all have to occur: a disjunction of conjunctions.
Query = frozenset | None
_MOST_STRINGS, _MOST_CLASS = 64, 4


def _both(a: Query, b: Query) -> Query:
    if a is None or b is None:
        return b if a is None else a
    return _least(frozenset(x | y for x in a for y in b))


def _least(alternatives: frozenset) -> Query:
    """Without the alternatives that another one implies; None if one of them asks for nothing."""
    if frozenset() in alternatives:
        return None
    return frozenset(x for x in alternatives if not any(y < x for y in alternatives))


def _of_strings(strings: set[bytes]) -> Query:
    return _least(frozenset(frozenset(s[i:i + 3] for i in range(len(s) - 2)) for s in strings))


def _folded(code: int) -> bytes:
    return chr(code).encode().lower()


def _strings(op, arg) -> set[bytes] | None:
    """All strings that a node can match, case folded, or None where there are many."""
    if op is _c.LITERAL:
        return {_folded(arg)}
    if op is _c.IN:
        found: set[bytes] = set()
        for kind, value in arg:
            if kind is _c.LITERAL:
                found.add(_folded(value))
            elif kind is _c.RANGE and value[1] - value[0] < _MOST_CLASS:
                found |= {_folded(x) for x in range(value[0], value[1] + 1)}
            else:
                return None
        return found if len(found) <= 2 * _MOST_CLASS else None
    if op is _c.SUBPATTERN:
        return _all(arg[3])
    if op is _c.BRANCH:
        each = [_all(x) for x in arg[1]]
        return None if any(x is None for x in each) else set().union(*each)
    if op in (_c.MAX_REPEAT, _c.MIN_REPEAT) and arg[1] <= 2:
        one = _all(arg[2])
        if one is None:
            return None
        found, grown = ({b""} if arg[0] == 0 else set()), {b""}
        for k in range(1, int(arg[1]) + 1):
            grown = {a + b for a in grown for b in one}
            found |= grown if k >= arg[0] else set()
        return found if len(found) <= _MOST_STRINGS else None
    if op is _c.AT:
        return {b""}
    return None


def _all(nodes) -> set[bytes] | None:
    found = {b""}
    for op, arg in nodes:
        one = _strings(op, arg)
        if one is None:
            return None
        found = {a + b for a in found for b in one}
        if len(found) > _MOST_STRINGS:
            return None
    return found


def _walk(nodes) -> Query:
    need, run = None, {b""}
    for op, arg in nodes:
        one = _strings(op, arg)
        if one is not None and len(run) * len(one) <= _MOST_STRINGS:
            run = {a + b for a in run for b in one}
            continue
        need, run = _both(need, _of_strings(run)), {b""}
        if one is not None:
            run = one
        elif op is _c.SUBPATTERN:
            need = _both(need, _walk(arg[3]))
        elif op is _c.BRANCH:
            each = [_walk(x) for x in arg[1]]
            need = _both(need, None if any(x is None for x in each) else _least(frozenset().union(*each)))
        elif op in (_c.MAX_REPEAT, _c.MIN_REPEAT) and arg[0] >= 1:
            need = _both(need, _walk(arg[2]))
    return _both(need, _of_strings(run))


def trigram_query(pattern: str) -> Query:
    """What trigrams (of UTF-8 bytes, ASCII letters in lower case) every match of the pattern holds."""
    return _walk(_parser.parse(pattern, re.ASCII))


class BlockIndex:
    """Inverted index of one block of texts, for the trigrams asked for."""

    def __init__(self, lookup: np.ndarray, trigrams: list[bytes], texts: list[bytes]):
        """lookup: by trigram, as a number of 24 bits, its place in ``trigrams`` plus 1, or 0."""
        joined = np.frombuffer(b"\0".join(texts).lower() + b"\0\0", np.uint8).astype(np.uint32)
        place = lookup[joined[:-2] << 16 | joined[1:-1] << 8 | joined[2:]]
        where = np.flatnonzero(place)
        starts = np.cumsum([0, *(len(t) + 1 for t in texts)])
        rows = np.searchsorted(starts, where, side="right") - 1
        pairs = np.unique((place[where].astype(np.int64) - 1) * len(texts) + rows)
        cuts = np.searchsorted(pairs, np.arange(len(trigrams) + 1, dtype=np.int64) * len(texts))
        self.n = len(texts)
        self.postings = {t: (pairs[a:b] % len(texts)) for t, a, b in zip(trigrams, cuts, cuts[1:])}

    def rows(self, need: Query) -> np.ndarray:
        """Rows that hold all trigrams of one of the alternatives."""
        if need is None:
            return np.arange(self.n)
        found = np.zeros(0, np.int64)
        for alternative in need:
            lists = sorted((self.postings[t] for t in alternative), key=len)
            common = lists[0]
            for more in lists[1:]:
                if not len(common):
                    break
                common = np.intersect1d(common, more, assume_unique=True)
            found = np.union1d(found, common)
        return found


def _trigrams(queries: list[Query]) -> list[bytes]:
    return sorted({t for q in queries if q is not None for alternative in q for t in alternative})


_LOOKUPS: dict[tuple, np.ndarray] = {}


def _lookup(trigrams: list[bytes]) -> np.ndarray:
    """Kept by each Python worker for the rule set in use: 32 MB."""
    if tuple(trigrams) not in _LOOKUPS:
        _LOOKUPS.clear()
        table = np.zeros(1 << 24, np.uint16)
        table[[int.from_bytes(t, "big") for t in trigrams]] = np.arange(1, len(trigrams) + 1)
        _LOOKUPS[tuple(trigrams)] = table
    return _LOOKUPS[tuple(trigrams)]


def find_spans(rule: Rule, compiled: re.Pattern, text: str) -> Iterator[tuple[int, int]]:
    for match in compiled.finditer(text):
        if rule.scan and match.group(1) is None:
            continue
        if match.end(rule.group) - match.start(rule.group) >= rule.min_chars:
            yield match.span()


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``id_col`` and spans (array of kind, start, end; by start, then in the order of the rules) for every row."""
    queries = [trigram_query(r.pattern) for r in rules]
    trigrams = _trigrams(queries)
    compiled = [r.compiled() for r in rules]
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])

    def run(batches):
        lookup = _lookup(trigrams)
        for batch in batches:
            for part in pieces(batch, text_col):
                texts = part.column(text_col).to_pylist()
                index = BlockIndex(lookup, trigrams, [utf8(t) for t in texts])
                found: list[list] = [[] for _ in texts]
                for k, (rule, need, pattern) in enumerate(zip(rules, queries, compiled, strict=True)):
                    for row in index.rows(need).tolist():
                        if texts[row]:
                            found[row] += [(start, k, end) for start, end in find_spans(rule, pattern, texts[row])]
                spans = [[{"kind": rules[k].kind, "start": start, "end": end} for start, k, end in sorted(x)] for x in found]
                yield pa.RecordBatch.from_arrays([part.column(id_col), pa.array(spans, pa.list_(span))], names=[id_col, "spans"])

    out = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType),
                        T.StructField("spans", T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()),
                                                                         T.StructField("end", T.LongType())])))])
    return docs.select(*dict.fromkeys([id_col, text_col])).mapInArrow(run, out)


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """trigram, block (numbered within the task), part (the task) and ids: the postings.  A posting list ends with its block, so a
    frequent trigram has many rows of bounded length, not one long one."""
    trigrams = _trigrams([trigram_query(r.pattern) for r in rules])
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"), F.spark_partition_id().alias("_part"))
    id_type = rows.schema["_id"].dataType

    def run(batches):
        lookup, block = _lookup(trigrams), 0
        for batch in batches:
            for part in pieces(batch, "_text"):
                index = BlockIndex(lookup, trigrams, [utf8(t) for t in part.column("_text").to_pylist()])
                held = [(t, x) for t, x in index.postings.items() if len(x)]
                ids = [part.column("_id").take(pa.array(x)) for _, x in held]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([t.decode("latin-1") for t, _ in held], pa.string()), pa.array([block] * len(held), pa.int32()),
                     pa.array([part.column("_part")[0].as_py()] * len(held), pa.int32()),
                     pa.array([x.to_pylist() for x in ids], pa.list_(part.schema.field("_id").type))], names=["trigram", "block", "part", "ids"])
                block += 1

    schema = T.StructType([T.StructField("trigram", T.StringType()), T.StructField("block", T.IntegerType()), T.StructField("part", T.IntegerType()),
                           T.StructField("ids", T.ArrayType(id_type))])
    return rows.mapInArrow(run, schema)


def candidates(index: DataFrame, rule: Rule) -> DataFrame | None:
    """From the postings alone: the ids that the rule may match (column id).  None: every document."""
    need = trigram_query(rule.pattern)
    if need is None:
        return None
    spark = index.sparkSession
    asked = spark.createDataFrame([(k, t.decode("latin-1"), len(a)) for k, a in enumerate(sorted(need, key=sorted)) for t in a],
                                  "alternative int, trigram string, size int")
    posted = index.join(F.broadcast(asked), "trigram").select("alternative", "size", "trigram", "part", "block", F.explode("ids").alias("id"))
    return (posted.groupBy("alternative", "size", "part", "block", "id").agg(F.count_distinct("trigram").alias("n"))
            .filter("n = size").select("id").distinct())


def _sql() -> str:
    def cased(word: str) -> str:
        return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)
    each = []
    for k, r in enumerate(RULES):
        pattern = r.pattern.replace(f"((?i:{_KEYWORDS}))", "(" + cased(_KEYWORDS) + ")").replace("'", "''")
        size = f"length(regexp_extract(part, '{pattern}', {r.group}))" if r.group else "length(part)"
        each.append(f"""SELECT r, {k} AS k, '{r.kind}' AS kind, i, part, {size} AS size FROM (SELECT r, generate_subscripts(p, 1) AS i, unnest(p) AS part
  FROM (SELECT r, string_split(regexp_replace(t, '{pattern}', chr(1) || '\\0' || chr(1), 'g'), chr(1)) AS p FROM d))""")
    least = "[" + ", ".join(str(r.min_chars) for r in RULES) + "]"
    text = "string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, k)"
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, row_number() OVER () AS r FROM documents),
s AS ({" UNION ALL ".join(each)}),
p AS (SELECT *, sum(length(part)) OVER (PARTITION BY r, k ORDER BY i) AS stop, stop - length(part) AS start FROM s),
h AS (SELECT * FROM p WHERE i % 2 = 0 AND size >= {least}[k + 1]),
g AS (SELECT r, count(*) FILTER (k = 0) AS n_assign, count(*) FILTER (k = 1) AS n_access, count(*) FILTER (k = 2) AS n_hex,
        {text} FILTER (k < 3) AS base, {text} AS spans FROM h GROUP BY r)
SELECT doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access, coalesce(n_hex, 0)::BIGINT AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN g USING (r)
"""


@query("op1_secret_scan", _sql())
def op1(spark, sf_dir):
    found = scan_secrets(documents(spark, sf_dir))

    def of(kind):
        return F.filter("spans", lambda s: s["kind"] == kind)

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    base = F.filter("spans", lambda s: s["kind"].isin([r.kind for r in BASE_RULES]))
    return found.select("doc_id", *(F.size(of(r.kind)).cast("long").alias(f"n_{r.kind}") for r in BASE_RULES),
                        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))
