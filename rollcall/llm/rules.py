"""Quality rules over whole texts, kept as a ledger of failure bits.

Every rule is evaluated once per document. The ledger holds the measurements and one bit for each rule that failed; a
policy is a version and a mask of rules, so a new policy, or an ablation of one, reads the ledger and no text.

Words are the longest runs of characters other than space and the control characters 9 to 13.
Null texts count as empty; an empty text has no words and no lines. Repeated rows are judged one by one.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.llm.shared import SPACES, without

WINDOW = 8
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_same"]

#: Name and failure condition of each rule, in SQL over the measurements. A rule's bit is its place; only append.
RULES = {
    "few_words": "n_words < 20",
    "repeated_windows": "100 * n_repeat_words > 30 * n_words",
    "symbols": "100 * n_symbols > 20 * n_words",
    "capitals": "100 * n_upper > 30 * word_chars",
    "same_word_again": "100 * n_same > 25 * n_words",
    "repeated_lines": "n_lines >= 4 and 100 * n_dup_lines > 60 * n_lines",
    "long_words": "word_chars > 20 * n_words",
}


@dataclass(frozen=True)
class Policy:
    """Rules whose failure rejects a document."""

    version: str
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(1 << place for place, name in enumerate(RULES) if name in self.rules)


BASE = Policy("base", ("few_words", "repeated_windows"))
FULL = Policy("full-1", tuple(RULES))


def let(value: Column, body) -> Column:
    """The body with the value's name bound to it, computed once."""
    return F.transform(F.array(value), body)[0]


def repeated(hashes: Column) -> Column:
    """Words in windows that occur twice or more, given each word's hash.

    Windows are compared by a 64-bit hash within one document. Most have no window twice, which a set shows; for the
    others equal windows meet by sorting, and the words they cover are counted from left to right.
    """
    windows = F.transform(F.sequence(F.lit(1), F.size(hashes) - (WINDOW - 1)), lambda at: F.xxhash64(F.slice(hashes, at, WINDOW)))

    def covered(windows: Column) -> Column:
        placed = F.sort_array(F.transform(windows, lambda window, at: F.struct(window.alias("window"), at.alias("at"))))
        twice = let(
            placed,
            lambda rows: F.filter(
                rows,
                lambda row, k: row["window"].eqNullSafe(F.get(rows, k - 1)["window"]) | row["window"].eqNullSafe(F.get(rows, k + 1)["window"]),
            ),
        )
        starts = F.sort_array(F.transform(twice, lambda row: row["at"]))
        none = F.struct(F.lit(0).alias("words"), F.lit(0).alias("end"))
        return F.aggregate(
            starts,
            none,
            lambda so_far, at: F.struct(
                (so_far["words"] + F.least(F.lit(WINDOW), at + WINDOW - so_far["end"])).alias("words"), (at + WINDOW).alias("end")
            ),
            lambda so_far: so_far["words"],
        )

    count = let(windows, lambda w: F.when(F.size(F.array_distinct(w)) < F.size(w), covered(w)).otherwise(0))
    return F.when(F.size(hashes) >= WINDOW, count).otherwise(0)


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds the measurements; given columns of their names are replaced."""
    docs = without(docs, *MEASURES)
    given = docs.columns
    whole = docs.withColumn("_text", F.coalesce(F.col(text), F.lit("")))
    words = F.filter(F.split("_text", r"[\x20\x09-\x0D]+"), lambda word: word != "")
    lines = F.filter(F.split("_text", "\n"), lambda line: F.btrim(line, F.lit(SPACES)) != "")
    parts = whole.withColumn("_words", words).withColumn("_lines", lines)
    parts = parts.withColumn("_hashes", F.transform("_words", lambda word: F.xxhash64(word)))
    hashes = F.col("_hashes")
    counts = {
        "n_words": F.size("_words"),
        "word_chars": F.length(F.array_join("_words", "")),
        "n_symbols": F.regexp_count("_text", F.lit(r"[#*$%&|<>]")),
        "n_dup_lines": F.size("_lines") - F.size(F.array_distinct("_lines")),
        "n_repeat_words": repeated(hashes),
        "n_lines": F.size("_lines"),
        "n_upper": F.regexp_count("_text", F.lit(r"\p{Lu}")),
        "n_same": F.size(F.filter(hashes, lambda word, at: word.eqNullSafe(F.get(hashes, at - 1)))),
    }
    return parts.select(*[f"`{c}`" for c in given], *[value.cast("long").alias(name) for name, value in counts.items()])


def ledger(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds the measurements and `failed`, the bits of the rules that failed."""
    bits = [F.when(F.expr(condition), F.lit(1 << place)).otherwise(0) for place, condition in enumerate(RULES.values())]
    total = bits[0]
    for bit in bits[1:]:
        total = total.bitwiseOR(bit)
    return measured(without(docs, "failed"), text).withColumn("failed", total.cast("long"))


def rejects(policy: Policy) -> Column:
    return F.col("failed").bitwiseAND(F.lit(policy.mask)) != 0


def ablations(ledger: DataFrame, *policies: Policy) -> DataFrame:
    """Per policy and rule: documents it rejects, those that fail the rule, and those kept if the rule went.

    Documents are counted by their bits first; what is left is one row per pattern of bits, whatever the corpus.
    """
    patterns = ledger.groupBy("failed").agg(F.count("*").alias("docs"))
    cases = [
        F.struct(F.lit(p.version).alias("policy"), F.lit(name).alias("rule"), F.lit(p.mask).alias("mask"), F.lit(1 << place).alias("bit"))
        for p in policies
        for place, name in enumerate(RULES)
        if name in p.rules
    ]
    each = patterns.select("failed", "docs", F.inline(F.array(*cases)))
    of_mask = F.col("failed").bitwiseAND(F.col("mask"))
    count = lambda condition: F.sum(F.when(condition, F.col("docs")).otherwise(0))
    return each.groupBy("policy", "rule").agg(
        count(of_mask != 0).alias("rejected"),
        count(of_mask.bitwiseAND(F.col("bit")) != 0).alias("failed_rule"),
        count(of_mask == F.col("bit")).alias("kept_without"),
        F.bit_or(F.when(of_mask.bitwiseAND(F.col("bit")) != 0, of_mask).otherwise(0)).alias("failed_with"),
    )


def verdicts(docs: DataFrame, policy: Policy = FULL) -> DataFrame:
    """Per document: the measurements of the contract, whether the base rules fail, and whether the policy keeps it."""
    rows = ledger(docs.select("doc_id", "text"))
    return rows.select("doc_id", *MEASURES[:5], rejects(BASE).alias("base_failed"), (~rejects(BASE) & ~rejects(policy)).alias("kept"), "failed")


ORACLE = r"""
with docs as (select row_number() over () as r, doc_id, coalesce(text, '') as t from documents),
parts as (
  select *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') as words,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines
  from docs),
windows as (
  select r, i, words[i:i + 7] as w from (select r, words, unnest(range(1, len(words) - 6)) as i from parts where len(words) >= 8)),
twice as (select r, i from (select r, i, count(*) over (partition by r, w) as c from windows) where c > 1),
covered as (select r, count(distinct p) as n from (select r, unnest(range(i, i + 8)) as p from twice) group by r),
measured as (
  select doc_id, len(words)::bigint as n_words, length(array_to_string(words, ''))::bigint as word_chars,
         (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::bigint as n_symbols,
         (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines, coalesce(n, 0)::bigint as n_repeat_words,
         len(lines)::bigint as n_lines, (length(t) - length(regexp_replace(t, '\p{Lu}', '', 'g')))::bigint as n_upper,
         len(list_filter(range(2, len(words) + 1), lambda i: words[i] = words[i - 1]))::bigint as n_same
  from parts left join covered using (r)),
bits as (
  select *, ((n_words < 20)::bigint + 2 * (100 * n_repeat_words > 30 * n_words)::bigint
    + 4 * (100 * n_symbols > 20 * n_words)::bigint + 8 * (100 * n_upper > 30 * word_chars)::bigint
    + 16 * (100 * n_same > 25 * n_words)::bigint + 32 * (n_lines >= 4 and 100 * n_dup_lines > 60 * n_lines)::bigint
    + 64 * (word_chars > 20 * n_words)::bigint)::bigint as failed
  from measured)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failed & 3 <> 0 as base_failed, failed = 0 as kept, failed
from bits
"""
