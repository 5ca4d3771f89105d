"""Quality rules as a bitmask ledger.

``build_ledger`` measures every document and evaluates every rule once: one row per document with
the measurements and a long whose bit *i* is set when rule *i* fails.  What happens with a failure
is a *policy*: a version name and the set of rules it enforces, kept as a mask.  Policies are
applied to the ledger by a bitwise AND, without the texts, and ``ablation`` counts, per policy and
rule, the documents that fail it, that fail only it, and that the policy would win back without it.
It first reduces the ledger to one row per distinct mask, so at most 2^rules rows are shuffled.

Edge cases: a null or empty text has all measurements 0 and fails ``few_words``; a rule whose
denominator is 0 does not fail; repeated rows are measured one by one; an empty table gives empty
results.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, documents, map_texts, saved, shared_dir, utf8
from .registry import query

SYMBOLS = b"#*$%&|<>"
_CONTINUATION = bytes(range(0x80, 0xC0))
_UPPER = bytes(range(0x41, 0x5B))
_LOWER = bytes(range(0x61, 0x7B))
_NOT_LETTER = bytes(b for b in range(0x80) if b not in _UPPER + _LOWER + SPACE)

MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_upper", "n_lower",
            "n_letter_words")


@dataclass(frozen=True)
class Rule:
    name: str
    fails: Column


def default_rules() -> list[Rule]:
    """In ledger order: the position is the bit, so new rules go to the end."""
    c = F.col
    return [
        Rule("few_words", c("n_words") < 50),
        Rule("repeated_windows", 100 * c("n_repeat_words") > 50 * c("n_words")),
        Rule("many_words", c("n_words") > 1_000_000),
        Rule("short_mean_word", c("word_chars") < 2 * c("n_words")),
        Rule("long_mean_word", c("word_chars") > 20 * c("n_words")),
        Rule("symbols", 10 * c("n_symbols") > 2 * c("n_words")),
        Rule("duplicate_lines", 2 * c("n_dup_lines") > c("n_lines")),
        Rule("upper_case", 2 * c("n_upper") > c("n_upper") + c("n_lower")),
        Rule("few_letter_words", 10 * c("n_letter_words") < 7 * c("n_words")),
    ]


#: Version -> names of the rules that reject a document.
POLICIES = {
    "base": ("few_words", "repeated_windows"),
    "2024-1": ("few_words", "repeated_windows", "symbols", "duplicate_lines", "upper_case"),
    "2024-2": ("few_words", "repeated_windows", "many_words", "short_mean_word", "long_mean_word", "symbols",
               "duplicate_lines", "upper_case", "few_letter_words"),
}


def measure(text: str | None) -> tuple[int, ...]:
    """The measurements of one text, in the order of MEASURES (words are split at ASCII white space)."""
    raw = utf8(text)
    words = raw.split()
    n = len(words)
    n_lines = n_dup = 0
    seen = set()
    for line in raw.split(b"\n"):
        if line.strip():
            n_lines += 1
            if line in seen:
                n_dup += 1
            seen.add(line)
    windows = list(zip(words, words[1:], words[2:], strict=False))
    n_repeat = 0
    if len(set(windows)) < len(windows):
        often = {w for w, k in Counter(windows).items() if k > 1}
        end = 0  # words before it are counted
        for i, w in enumerate(windows):
            if w in often:
                n_repeat += i + 3 - max(i, end)
                end = i + 3
    length = len(raw)
    return (n, len(raw.translate(None, SPACE + _CONTINUATION)), length - len(raw.translate(None, SYMBOLS)), n_lines, n_dup,
            n_repeat, length - len(raw.translate(None, _UPPER)), length - len(raw.translate(None, _LOWER)),
            len(raw.translate(None, _NOT_LETTER).split()))


def _measure_all(texts: list[str | None]) -> list[pa.Array]:
    return [pa.array(column, pa.int64()) for column in zip(*map(measure, texts), strict=True)]


def build_ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 rules: list[Rule] | None = None) -> DataFrame:
    """``id_col``, the measurements and ``failed_bits`` (long), one row per row of ``docs``."""
    measured = map_texts(docs, text_col, _measure_all, ", ".join(f"{m} long" for m in MEASURES), [id_col])
    bits = F.lit(0).cast("long")
    for i, rule in enumerate(rules or default_rules()):
        bits = bits.bitwiseOR(F.when(rule.fails, F.lit(1 << i)).otherwise(F.lit(0)).cast("long"))
    return measured.withColumn("failed_bits", bits)


def policy_mask(names: tuple[str, ...], rules: list[Rule] | None = None) -> int:
    known = [r.name for r in rules or default_rules()]
    if unknown := set(names) - set(known):
        raise ValueError(f"the policy names rules that the ledger lacks: {sorted(unknown)}")
    return sum(1 << known.index(n) for n in names)


def apply_policy(ledger: DataFrame, names: tuple[str, ...], rules: list[Rule] | None = None,
                 into: str = "kept") -> DataFrame:
    """The ledger with a boolean: true where no rule of the policy failed."""
    mask = F.lit(policy_mask(names, rules)).cast("long")
    return ledger.withColumn(into, F.col("failed_bits").bitwiseAND(mask) == 0)


def ablation(ledger: DataFrame, policies: dict[str, tuple[str, ...]] | None = None,
             rules: list[Rule] | None = None) -> DataFrame:
    """policy, rule, n_failed (documents that fail the rule), n_only (that the policy rejects for this rule
    alone: won back without it), n_rejected (that the policy rejects) and n_docs."""
    rules = rules or default_rules()
    by_mask = ledger.groupBy("failed_bits").agg(F.count(F.lit(1)).alias("n"))
    plan = [F.struct(F.lit(v).alias("policy"), F.lit(r).alias("rule"), F.lit(policy_mask(names, rules)).cast("long").alias("mask"),
                     F.lit(policy_mask((r,), rules)).cast("long").alias("bit")) for v, names in (policies or POLICIES).items() for r in names]
    own = F.col("failed_bits").bitwiseAND(F.col("mask"))
    counted = lambda cond: F.sum(F.when(cond, F.col("n")).otherwise(0))
    return (by_mask.select("failed_bits", "n", F.inline(F.array(*plan)))  # a fixed few rows a mask: one per policy and rule
            .groupBy("policy", "rule")
            .agg(counted(own.bitwiseAND(F.col("bit")) != 0).alias("n_failed"), counted(own == F.col("bit")).alias("n_only"),
                 counted(own != 0).alias("n_rejected"), F.sum("n").alias("n_docs")))


_ORACLE = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, row_number() OVER () AS r FROM documents),
w AS (SELECT r, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d),
win AS (SELECT r, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g
        FROM (SELECT r, ws, unnest(generate_series(1, len(ws) - 2)) AS i FROM w)),
often AS (SELECT r, g FROM win GROUP BY r, g HAVING count(*) > 1),
rep AS (SELECT r, count(DISTINCT i + k) AS n FROM win JOIN often USING (r, g), (VALUES (0), (1), (2)) AS o(k) GROUP BY r),
li AS (SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT l) AS n_dup
       FROM (SELECT r, unnest(string_split(t, chr(10))) AS l FROM d) WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY r),
m AS (SELECT w.r, doc_id, len(ws)::BIGINT AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
        length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, coalesce(n_lines, 0) AS n_lines,
        coalesce(n_dup, 0) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words,
        length(regexp_replace(t, '[^A-Z]', '', 'g')) AS up, length(regexp_replace(t, '[^a-z]', '', 'g')) AS lo,
        len(regexp_extract_all(t, '[^\x20\x09-\x0D]*[A-Za-z\x{80}-\x{10FFFF}][^\x20\x09-\x0D]*')) AS n_letter
      FROM w LEFT JOIN rep USING (r) LEFT JOIN li USING (r)),
b AS (SELECT *, (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR n_words > 1000000 OR word_chars < 2 * n_words OR word_chars > 20 * n_words OR 10 * n_symbols > 2 * n_words
       OR 2 * n_dup_lines > n_lines OR 2 * up > up + lo OR 10 * n_letter < 7 * n_words) AS kept
FROM b
"""


@query("op2_quality_rules", _ORACLE)
def op2(spark, sf_dir):
    """Every document against the newest policy; ``base_failed`` is the policy ``base``.  The ablation of all policies
    over the whole ledger is written to the shared folder ``op2_ablation``."""
    ledger = saved(build_ledger(documents(spark, sf_dir)))
    ablation(ledger).write.parquet(shared_dir(spark, "op2_ablation"))
    judged = apply_policy(apply_policy(ledger, POLICIES["base"], into="base_kept"), POLICIES["2024-2"])
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         (~F.col("base_kept")).alias("base_failed"), "kept")
