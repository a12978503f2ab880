"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document. The ledger keeps the measurements
and one ``failures`` bit per rule; policies are versioned masks over those
bits, so a new policy, or leaving one rule out, needs no second look at the
texts.

Rows: one per input row. A null or empty text has no words (all measurements
0, too few words fails). Repeated rows and ids give repeated ledger rows.
Other columns of the input are ignored, so clashing names do no harm. An
empty table gives an empty ledger.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACES = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
WINDOW = 3

# Rules in bit order: name and failing condition over the measurements.
# Conditions are integer SQL so that they mean the same in any engine.
RULES = {
    "few_words": "n_words < 50",
    "repeated_windows": "100 * n_repeat_words > 50 * n_words",
    "symbols": "100 * n_symbols > 25 * n_words",
    "duplicate_lines": "n_lines >= 4 and 100 * n_dup_lines > 50 * n_lines",
    "short_words": "word_chars < 2 * n_words",
    "long_words": "word_chars > 25 * n_words",
    "shouting": "100 * n_capitals > 60 * word_chars",
}
BIT = {name: i for i, name in enumerate(RULES)}

# Versioned policies: the rules whose failure rejects a document.
POLICIES = {
    "v1": ("few_words", "repeated_windows"),
    "v2": ("few_words", "repeated_windows", "symbols", "duplicate_lines"),
    "v3": tuple(RULES),
}
BASE_POLICY, CURRENT_POLICY = "v1", "v3"


def mask(rules) -> int:
    """The bits of the named rules."""
    return sum(1 << BIT[r] for r in rules)


def _with(value: Column, body) -> Column:
    """``body`` of a value that is computed once and bound to a lambda variable."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _repeated(hashes: Column) -> Column:
    """Words covered by windows found twice or more; ``hashes``: one per window, in order.

    Windows are compared by 64-bit hash within one document. Sorting
    (hash, place) brings equal windows together; the places of those with an
    equal neighbour, in order, each add up to ``WINDOW`` newly covered words.
    """
    def places(ordered):
        twin = lambda x, i: ((x["h"] == F.get(ordered, i + 1)["h"])
                             | (x["h"] == F.get(ordered, i - 1)["h"]))
        found = F.filter(ordered, lambda x, i: F.coalesce(twin(x, i), F.lit(False)))
        return F.sort_array(F.transform(found, lambda x: x["i"]))

    def covered(at):
        start = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("n"))
        return F.aggregate(at, start, lambda acc, p: F.struct(
            p.alias("last"), (acc["n"] + F.least(F.lit(WINDOW), p - acc["last"])).alias("n")),
            lambda acc: acc["n"])

    ordered = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes),
                  _with(_with(ordered, places), covered)).otherwise(F.lit(0))


def _measured(words: Column) -> Column:
    n = F.size(words)
    windows = F.transform(F.sequence(F.lit(0), n - WINDOW), lambda i: F.xxhash64(
        *[F.get(words, i + k) for k in range(WINDOW)]))
    return F.struct(n.cast("long").alias("n_words"),
                    F.when(n > WINDOW, _with(windows, _repeated)).otherwise(F.lit(0)).cast("long")
                    .alias("n_repeat_words"))


def measurements(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The counts that the rules use, one row per document."""
    t = F.coalesce(F.col(text), F.lit(""))
    words = F.filter(F.split(t, SPACES), lambda w: w != "")
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    staged = docs.select(F.col(doc_id).alias("doc_id"), t.alias("t"),
                         _with(words, _measured).alias("w"), _with(lines, lambda x: F.struct(
                             F.size(x).alias("n"), F.size(F.array_distinct(x)).alias("d"))).alias("l"))
    count = lambda c: F.length(c).cast("long")
    return staged.select(
        "doc_id", F.col("w.n_words").alias("n_words"),
        count(F.translate("t", " \t\n\x0b\f\r", "")).alias("word_chars"),
        (count(F.col("t")) - count(F.translate("t", SYMBOLS, ""))).alias("n_symbols"),
        F.col("l.n").cast("long").alias("n_lines"),
        (F.col("l.n") - F.col("l.d")).cast("long").alias("n_dup_lines"),
        F.col("w.n_repeat_words").alias("n_repeat_words"),
        (count(F.col("t")) - count(F.translate("t", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))).alias("n_capitals"))


def ledger(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Measurements and ``failures``: bit ``BIT[rule]`` is set where the rule fails."""
    measured = measurements(docs, text, doc_id)
    bits = sum((F.when(F.expr(condition), F.lit(1 << BIT[name])).otherwise(F.lit(0))
                for name, condition in RULES.items()), F.lit(0))
    return measured.withColumn("failures", bits.cast("long"))


def apply_policy(rows: DataFrame, policy: str, name: str = "kept") -> DataFrame:
    """``name``: whether no rule of the policy failed."""
    return rows.withColumn(name, F.col("failures").bitwiseAND(F.lit(mask(POLICIES[policy]))) == 0)


def ablations(rows: DataFrame, policy: str) -> DataFrame:
    """Per rule of a policy: documents it fails, and those that only it rejects.

    The ledger is first counted by failure mask (at most 2^rules rows, partial
    counts before the shuffle); the rest is bit arithmetic on that table.
    """
    rules = POLICIES[policy]
    seen = (rows.groupBy(F.col("failures").bitwiseAND(F.lit(mask(rules))).alias("bits"))
            .agg(F.count(F.lit(1)).alias("docs")))
    each = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(1 << BIT[r]).cast("long").alias("bit"))
                               for r in rules]))
    return (seen.select("bits", "docs", each.alias("r")).groupBy(F.col("r.rule").alias("rule"))
            .agg(F.sum(F.when(F.col("bits").bitwiseAND(F.col("r.bit")) != 0, F.col("docs")).otherwise(0)).alias("failed"),
                 F.sum(F.when(F.col("bits") == F.col("r.bit"), F.col("docs")).otherwise(0)).alias("only_by_it"),
                 F.bit_or("bits").alias("policy_bits_seen")))


def op10(docs: DataFrame) -> DataFrame:
    rows = apply_policy(apply_policy(ledger(docs), BASE_POLICY, "base_kept"), CURRENT_POLICY)
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                       (~F.col("base_kept")).alias("base_failed"), "kept", "failures")


def op10_sql() -> str:
    """The same rows by DuckDB, windows compared as texts."""
    bits = " + ".join(f"case when {c} then {1 << BIT[n]} else 0 end" for n, c in RULES.items())
    return rf"""
with d as (select row_number() over () as k, doc_id, coalesce(text, '') as t from documents),
w as (select k, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') as words,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines from d),
win as (select k, unnest(range(1, len(words) - 1)) as i, words from w where len(words) >= 3),
tri as (select k, i, words[i] || ' ' || words[i+1] || ' ' || words[i+2] as s from win),
dup as (select k, i from (select k, i, count(*) over (partition by k, s) as n from tri) where n > 1),
rep as (select k, count(distinct j) as n from (select k, unnest([i, i+1, i+2]) as j from dup) group by k),
m as (select w.k, doc_id, len(words)::bigint as n_words,
             length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::bigint as word_chars,
             (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::bigint as n_symbols,
             len(lines)::bigint as n_lines, (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines,
             coalesce(rep.n, 0)::bigint as n_repeat_words,
             (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')))::bigint as n_capitals
      from w left join rep on rep.k = w.k),
f as (select *, ({bits})::bigint as failures from m)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (failures & {mask(POLICIES[BASE_POLICY])}) <> 0 as base_failed,
       (failures & {mask(POLICIES[CURRENT_POLICY])}) = 0 as kept, failures
from f"""
