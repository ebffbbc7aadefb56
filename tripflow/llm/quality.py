"""Quality rules as a bitmask ledger, in DataFrame functions only.

``ledger`` measures every text once and evaluates every rule once: the rules a
text fails are the bits of ``failed_bits``. ``stored_ledger`` writes it. A policy is a mask over the bits,
so a new policy version, or the cost of one rule within it, is read from the
ledger without touching the texts (``apply_policy``, ``ablations``).

Everything is row-local: no shuffle, no Python. Repeated 3-word windows are
found by sorting (hash, position) pairs inside the row, n log n in its words.

Defined results: a null or empty text has no words; a text of less than three
words has no window; repeated rows are judged each; an empty table gives an
empty ledger; further columns pass through ``ledger`` unless they bear the name
of a measurement, which then replaces them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.llm.work import stored_once

#: Words are runs of anything but space, tab, newline, vertical tab, form feed, return.
SPACES = " \t\n\x0b\x0c\r"
_SPLIT = "[\\x20\\x09-\\x0D]+"
SYMBOLS = "#*$%&|<>"

MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]

#: Rule -> condition under which a text fails it. The order fixes the bits.
RULES: dict[str, str] = {
    "few_words": "n_words < 50",
    "repeated_words": "100 * n_repeat_words > 50 * n_words",
    "symbols": "10 * n_symbols > 3 * word_chars",
    "long_words": "word_chars > 40 * n_words",
    "short_words": "word_chars < 2 * n_words",
    "repeated_lines": "10 * n_dup_lines > 6 * n_lines",
}
BASE = ("few_words", "repeated_words")

#: Policy version -> rules it enforces.
POLICIES: dict[str, tuple[str, ...]] = {
    "v1": BASE,
    "v2": tuple(RULES),
}
CURRENT = "v2"


def bits(rules: tuple[str, ...]) -> int:
    names = list(RULES)
    return sum(1 << names.index(rule) for rule in rules)


def _covered_words() -> list[dict[str, str]]:
    """Steps from the words ``_w`` to the words covered by 3-word windows that
    occur twice or more.

    Window hashes are sorted together with their positions; a window equal to a
    neighbour in that order is repeated. Each repeated window covers three
    words, less those the next one covers as well.
    """
    return [
        {
            "_h": "CASE WHEN n_words >= 3 THEN transform(sequence(2, size(_w) - 1), "
            "i -> xxhash64(_w[i - 2], _w[i - 1], _w[i])) ELSE array() END"
        },
        # Most short texts repeat nothing and skip the sort.
        {
            "_s": "CASE WHEN size(array_distinct(_h)) < size(_h) THEN "
            "array_sort(transform(_h, (x, i) -> struct(x AS x, i AS i))) END"
        },
        {
            "_p": "array_sort(transform(filter(_s, (p, j) -> (j > 0 AND _s[j - 1].x = p.x) "
            "OR (j < size(_s) - 1 AND _s[j + 1].x = p.x)), p -> p.i))"
        },
        {
            "n_repeat_words": "coalesce(aggregate(transform(_p, (x, j) -> CASE WHEN j < size(_p) - 1 "
            "THEN least(3, _p[j + 1] - x) ELSE 3 END), 0L, (a, b) -> a + b), 0L)"
        },
    ]


def _stepwise(df: DataFrame, steps: list[dict[str, str]]) -> DataFrame:
    for step in steps:
        df = df.withColumns({name: F.expr(text) for name, text in step.items()})
    return df


def measured(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with the measurements of every text (``MEASURES``, all long)."""
    body = F.coalesce(F.col(text), F.lit(""))
    bare = F.translate(body, SPACES, "")
    lines = F.filter(F.split(body, "\n"), lambda line: F.translate(line, SPACES, "") != "")
    kept = [c for c in df.columns if c not in MEASURES]
    symbols = F.length("_bare") - F.length(F.translate("_bare", SYMBOLS, ""))
    repeated = F.size("_lines") - F.size(F.array_distinct("_lines"))
    rows = df.select(
        *kept,
        F.array_remove(F.split(body, _SPLIT), "").alias("_w"),
        lines.alias("_lines"),
        bare.alias("_bare"),
    )
    rows = rows.select(
        *kept,
        "_w",
        F.size("_w").cast("long").alias("n_words"),
        F.length("_bare").cast("long").alias("word_chars"),
        symbols.cast("long").alias("n_symbols"),
        repeated.cast("long").alias("n_dup_lines"),
        F.size("_lines").cast("long").alias("n_lines"),
    )
    return _stepwise(rows, _covered_words()).select(*kept, *MEASURES)


def ledger(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with measurements and ``failed_bits``, one bit per rule failed."""
    rows = measured(df.drop("failed_bits"), text)
    flags = [f"CASE WHEN {rule} THEN {1 << k} ELSE 0 END" for k, rule in enumerate(RULES.values())]
    return rows.withColumn("failed_bits", F.expr(" + ".join(flags)).cast("long"))


def apply_policy(rows: DataFrame, policy: str = CURRENT) -> DataFrame:
    """The ledger with ``kept``: no rule of the policy failed."""
    return rows.withColumn("kept", F.col("failed_bits").bitwiseAND(bits(POLICIES[policy])) == 0)


def ablations(rows: DataFrame) -> DataFrame:
    """Per policy and rule: rows the rule fails, and rows kept if it were dropped.

    One grouping by ``failed_bits`` (at most two to the number of rules groups)
    holds all that is needed; policies and rules are crossed with those groups
    by array literals, not with the rows.
    """
    groups = rows.groupBy("failed_bits").agg(F.count("*").alias("n"))
    cases = [
        F.struct(
            F.lit(policy).alias("policy"),
            F.lit(rule).alias("rule"),
            F.lit(bits(enforced)).cast("long").alias("mask"),
            F.lit(bits((rule,))).cast("long").alias("bit"),
        )
        for policy, enforced in POLICIES.items()
        for rule in enforced
    ]
    crossed = groups.select("failed_bits", "n", F.explode(F.array(*cases)).alias("case"))
    failed = "failed_bits & case.mask"
    return crossed.groupBy("case.policy", "case.rule").agg(
        F.expr("sum(n)").alias("n_rows"),
        F.expr(f"sum(CASE WHEN {failed} = 0 THEN n ELSE 0 END)").alias("kept"),
        F.expr("sum(CASE WHEN failed_bits & case.bit != 0 THEN n ELSE 0 END)").alias("failed"),
        F.expr(f"sum(CASE WHEN {failed} = case.bit THEN n ELSE 0 END)").alias("regained"),
    )


def stored_ledger(spark: SparkSession, path: str, text: str = "text") -> DataFrame:
    """The ledger of a stored table without its texts, written once per application:
    policies and ablations over the same files read it and measure nothing again."""
    docs = spark.read.parquet(path).select("doc_id", text)
    return stored_once(ledger(docs, text).drop(text), "ledger", path)


def op4_quality(spark, sf_dir: str) -> DataFrame:
    judged = apply_policy(stored_ledger(spark, f"{sf_dir}/documents.parquet"))
    base = F.col("failed_bits").bitwiseAND(bits(BASE)) != 0
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base.alias("base_failed"), "kept", "failed_bits",
    )


def op4_ablations(spark, sf_dir: str) -> DataFrame:
    """The ablations of every policy over all documents."""
    return ablations(stored_ledger(spark, f"{sf_dir}/documents.parquet"))


def _judged_sql() -> str:
    rule_bits = " + ".join(
        f"CASE WHEN {rule} THEN {1 << k} ELSE 0 END" for k, rule in enumerate(RULES.values())
    )
    space = "[\\x20\\x09-\\x0D]"
    return f"""
    WITH body AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
    words AS (
      SELECT r, doc_id, t, list_filter(regexp_split_to_array(t, '{space}+'), lambda x: x <> '') AS w,
             regexp_replace(t, '{space}', '', 'g') AS bare,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls
      FROM body),
    spots AS (SELECT r, unnest(range(1, len(w) - 1)) AS i, w FROM words WHERE len(w) >= 3),
    windows AS (SELECT r, i, list_slice(w, i, i + 2) AS g FROM spots),
    twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM windows) WHERE n > 1),
    covered AS (
      SELECT r, count(DISTINCT k) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS k FROM twice) GROUP BY r),
    measures AS (
      SELECT doc_id, len(w) AS n_words, length(bare) AS word_chars,
             length(bare) - length(regexp_replace(bare, '[#*$%&|<>]', '', 'g')) AS n_symbols,
             len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words,
             len(ls) AS n_lines
      FROM words LEFT JOIN covered c USING (r)),
    judged AS (SELECT *, {rule_bits} AS failed_bits FROM measures)"""


def _oracle() -> str:
    return f"""{_judged_sql()}
    SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
           CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
           CAST(n_repeat_words AS BIGINT) AS n_repeat_words,
           (failed_bits & {bits(BASE)}) <> 0 AS base_failed,
           (failed_bits & {bits(POLICIES[CURRENT])}) = 0 AS kept,
           CAST(failed_bits AS BIGINT) AS failed_bits
    FROM judged"""


def _ablations_oracle() -> str:
    cases = ", ".join(
        f"('{policy}', '{rule}', {bits(enforced)}, {bits((rule,))})"
        for policy, enforced in POLICIES.items()
        for rule in enforced
    )
    return f"""{_judged_sql()}
    SELECT policy, rule, count(*) AS n_rows, count(*) FILTER (failed_bits & mask = 0) AS kept,
           count(*) FILTER (failed_bits & bit <> 0) AS failed,
           count(*) FILTER (failed_bits & mask = bit) AS regained
    FROM judged, (VALUES {cases}) AS cases(policy, rule, mask, bit) GROUP BY policy, rule"""


ORACLE_SQL = _oracle()
ABLATIONS_SQL = _ablations_oracle()
