"""Personal data in texts: fixed patterns, and candidates scored by boosted trees. SQL functions only.

Base spans are the matches of four patterns that pass their check. A pattern takes all it can, so a phone number followed
by a card number is one match, fails, and both are missed. Generators of high recall therefore propose narrower and
looser spans too, which may overlap. A span's format and context are its features; trees are fitted on the candidates of
all documents, equal ones once, and on those of a few fixed examples. Labels come from checks
of each kind (see `label`) that see more than the base patterns: check digits of cards and accounts, ranges, the address
behind a disguise, and cue words before; a candidate that can't be checked is not learnt from. Per kind, the lowest score at which nine of ten
candidates of a held-out part are right (smoothed) is the threshold. A kind with too few of them, or without such a score,
has a fixed one: where the trees give nine of ten. So tables of any size are treated alike. Candidates from the threshold
on that no base span holds are added.

The trees are fitted on the driver while the candidates are few, level by level on Spark beyond, and become one SQL
expression. Null texts count as empty. Rows are scanned one by one.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollcall.llm import trees
from rollcall.llm.shared import keep, scratch, without

KINDS = ("email", "ip", "card", "phone", "account")
#: The base patterns. Possessive repeats and the look behind change no match; they keep long runs linear:
#: a run of a pattern's first characters can match from its start or not at all, unless a match has just ended in it.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: What a text must contain for a pattern to be tried.
NEEDS = {"email": "@", "ip": "[0-9][.][0-9]", "card": "[0-9][ -]?[0-9]", "phone": r"\+[0-9]", "account": "[0-9]{2}"}
OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"

#: Generators: kind and pattern.
GENERATORS = (
    ("email", r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+ ?(?:@|\(at\)|\[at\]) ?[A-Za-z0-9-]++(?: ?(?:\.|\(dot\)|\[dot\]) ?[A-Za-z0-9-]++)++", r"@|\(at\)|\[at\]"),
    ("email", r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+ ?(?:@|\(at\)|\[at\]) ?[A-Za-z0-9-]++(?:(?:\.| ?\(dot\) ?| ?\[dot\] ?)[A-Za-z0-9-]++)++", r"@|\(at\)|\[at\]"),
    ("ip", r"(?<![0-9.])[0-9]{1,3}(?:\[?\.\]?[0-9]{1,3}){3}(?![0-9])", "[0-9][\\[.]"),
    ("card", r"(?<![0-9])(?:[0-9]{12,19}|[0-9]{4}(?:[ -][0-9]{4}){2}[ -][0-9]{1,7}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})(?![0-9])", "[0-9]{4}"),
    ("phone", r"(?<![0-9])\+?[0-9]{1,3}[ .-]?(?:\([0-9]{2,4}\)|[0-9]{2,4})[ .-]?[0-9]{3,4}[ .-][0-9]{3,4}(?![0-9])", "[0-9]{3}"),
    ("phone", r"(?<![0-9+])\([0-9]{2,4}\)[ .-]?[0-9]{3,4}[ .-][0-9]{3,4}(?![0-9])", r"\([0-9]{2}"),
    ("account", r"(?<![A-Za-z0-9])(?:[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?|[0-9]{3}-[0-9]{2}-[0-9]{4})(?![A-Za-z0-9])", "[0-9]{2}"),
)
CUES = {
    "phone_near": "phone|tel|call|mobile|fax|cell|whatsapp",
    "card_near": "card|visa|master|credit|amex|payment|cc",
    "mail_near": "mail|contact|write|reach|from|to:",
    "ip_near": "ip|host|server|address|client|login",
    "account_near": "iban|account|ssn|social|passport|bank|tax",
    "other_near": "version|v\\.|page|isbn|id|order|part|figure|section|chapter",
}
AROUND = 32
#: Candidates that the driver takes, all of them; with more, histograms are summed up on Spark. Held-out ones without which
#: a kind's threshold is FIXED; share of right ones at a threshold; the log odds at which the trees give that share.
ON_DRIVER, LEAST_HELD, PRECISION = 20_000, 50, 0.9
#: Scores of a kind are summed up in parts, so many for a step of one in the log odds.
PARTS = 64
FIXED = math.log(PRECISION / (1 - PRECISION))
#: Texts that the trees learn from on any table, so that small ones have a model as well: values and what stands around
#: them. Their candidates are labelled like all others, and count so many times.
EXAMPLES = (
    "joe.doe@mail.example.com", "a_b-c7@x1.example.org", "office@example.co.uk", "203.0.113.77", "8.8.4.4", "999.0.113.777", "10.300.2.500",
    "4111111111111111", "4111 1111 1111 1111", "3782-822463-10005", "4111111111111112", "1234 5678 9012 3456", "5500-0000-0000-0005", "202612041530",
    "joe.doe (at) example.com", "jane [at] mail [dot] example [dot] org", "info(at)example(dot)net", "joe @ example.com", "al_99 @ mail.example.org",
    "a1 [at] b2 [dot] c3", "3 @ 5.00", "12 @ 7.50", "joe@example.com. Then", "203.0.113[.]77", "8[.]8[.]4[.]4", "300[.]1[.]2[.]3", "7[.]999[.]1[.]1",
    "DE89 3704 0044 0532 0130 00", "GB82WEST12345698765432", "FR14 2004 1010 0505 0001 3M02 606", "DE88 3704 0044 0532 0130 00", "GB83WEST12345698765432",
    "FR15 2004 1010 0505 0001 3M02 606", "123-45-6789", "536-22-1234", "000-45-6789", "912-45-6789", "123-00-6789", "666-12-0000",
    "+1 (988) 555-2485 4111111111111111", "+1 200 555-0100 5500000000000004", "+49 (30) 1234-5678 202612041530", "+33 (14) 555-2030 8.8.4.4",
    "4111111111111111 4242424242424242", "(988) 555-2485", "988-555-2485", "020 7946 0958", "+1 (988) 555-2485", "+44 20 7946 0958", "+49 (30) 1234-5678", "12 345 678 901", "1-200-3000-4000", "(12) 3456-7890",
)
AROUND_EXAMPLES = ("{}", "and {} then", "call {}, please", "card {} expires", "write to {}.", "server {} up", "bank account {}", "order id {} sent", "social security {}", "tel {} or")
EXAMPLE_WEIGHT = 8
TREES = {"trees": 40, "depth": 4, "rate": 0.4}

FEATURES = [
    "kind", "length", "digits", "letters", "spaces", "hyphens", "dots", "plus", "brackets", "at", "luhn", "octets", "first_digit",
    "joined_before", "joined_after", "digit_after", "at_start", "checked", "disguised", "sentence_end", *CUES,
]


def found(text: Column, pattern: str, needs: str) -> Column:
    """All leftmost matches: start, end (code points), value, and up to AROUND characters before and after it."""
    steps = F.lit(rf"(?s)\G(.*?)({pattern})(?=(.{{0,{AROUND}}}))")
    parts = F.arrays_zip(*[F.regexp_extract_all(text, steps, F.lit(g)).alias(name) for g, name in ((1, "gap"), (2, "hit"), (3, "after"))])
    none = F.struct(F.lit(0).alias("end"), F.array().cast("array<struct<start:int,end:int,value:string,before:string,after:string>>").alias("spans"))

    def add(done: Column, part: Column) -> Column:
        start = done["end"] + F.length(part["gap"])
        end = start + F.length(part["hit"])
        before = F.lower(F.right(part["gap"], F.lit(AROUND)))
        span = F.struct(start.alias("start"), end.alias("end"), part["hit"].alias("value"), before.alias("before"), F.lower(part["after"]).alias("after"))
        return F.struct(end.alias("end"), F.concat(done["spans"], F.array(span)).alias("spans"))

    return F.when(text.rlike(needs), F.aggregate(parts, none, add, lambda done: done["spans"])).otherwise(none["spans"])


def digits(value: Column) -> Column:
    return F.regexp_replace(value, F.lit("[^0-9]"), F.lit(""))


def passes_luhn(value: Column) -> Column:
    """12 to 19 digits, whose sum with every second from the right doubled ends in 0."""

    def total(number: Column) -> Column:
        def add(so_far: Column, place: Column) -> Column:
            digit = F.substring(number, -place, F.lit(1)).cast("int") * F.when(place % 2 == 0, 2).otherwise(1)
            return so_far + digit - F.when(digit > 9, 9).otherwise(0)

        return F.aggregate(F.sequence(F.lit(1), F.length(number)), F.lit(0), add)

    right = lambda number: F.when(F.length(number).between(12, 19), total(number) % 10 == 0).otherwise(False)
    return F.transform(F.array(digits(value)), right)[0]


def passes_account(value: Column) -> Column:
    """An IBAN whose number, with letters as 10 to 35 and its first four characters last, leaves 1 divided by 97; or a
    social security number whose parts are in use."""

    def rest(plain: Column) -> Column:
        turned = F.concat(F.substring(plain, 5, 40), F.substring(plain, 1, 4))

        def add(so_far: Column, place: Column) -> Column:
            letter = F.substring(turned, place, F.lit(1))
            return F.when(letter.rlike("[0-9]"), so_far * 10 + F.ascii(letter) - 48).otherwise(so_far * 100 + F.ascii(letter) - 55) % 97

        return F.aggregate(F.sequence(F.lit(1), F.length(turned)), F.lit(0), add)

    number = value.rlike("^(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}$")
    right = lambda plain: F.when(plain.rlike("^[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}$"), rest(plain) == 1).otherwise(False)
    return number | F.transform(F.array(F.regexp_replace(value, " ", "")), right)[0]


def undisguised(kind: str, value: Column) -> Column:
    """A mail or IP address without what hides it."""
    if kind == "email":
        value = F.regexp_replace(value, r" ?(?:@|\(at\)|\[at\]) ?", "@")
        return F.regexp_replace(value, r" ?(?:\.|\(dot\)|\[dot\]) ?", ".")
    return F.regexp_replace(value, r"[\[\]]", "")


def checked(kind: str, value: Column) -> Column:
    """Whether a candidate of this kind passes what can be checked of its form."""
    if kind == "email":
        return undisguised(kind, value).rlike(r"^[A-Za-z0-9._%+-]+@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,24}$")
    if kind == "ip":
        return passes(kind, undisguised(kind, value))
    if kind == "phone":
        return F.length(digits(value)).between(7, 15) & ~value.rlike(r"^[0-9]+(?:\.[0-9]+){3}$")
    return passes_luhn(value) if kind == "card" else passes_account(value)


DISGUISE = r"\(at\)|\[at\]|\(dot\)|\[dot\]|\[\.|\.\]"


def label(kind: str, span: Column, base: Column) -> Column:
    """1 for personal data, 0 for none, null where that can't be told: cards and IBANs by their check digits; addresses
    in a base span or behind a disguise by their form, those with spaces around the @ by a cue too; phone numbers in a
    base span of phones or with a +, other ones and social security numbers by the cue before them."""
    value = span["value"]
    near = lambda *cues: span["before"].rlike("|".join(f"(?:{CUES[cue]})" for cue in cues))
    of = lambda *kinds: F.filter(base, lambda s: s["kind"].isin(*[KINDS.index(k) for k in kinds]))
    fails = F.when(~checked(kind, value), 0)
    if kind == "email":
        holds = F.exists(of("email"), lambda s: (span["start"] <= s["start"]) & (s["end"] <= span["end"]))
        good = fails.when(inside(span, of("email")), 1).when(holds | value.rlike("[^ ][.] "), 0)
        return good.when(value.rlike(DISGUISE) | near("mail_near"), 1)
    if kind == "ip":
        return fails.when(inside(span, of("ip")) | value.rlike(DISGUISE), 1)
    if kind == "phone":
        good = fails.when(inside(span, of("phone")), 1).when(passes_luhn(value) | inside(span, of("card", "ip")), 0)
        good = good.when(value.startswith("+"), F.length(digits(value)).between(9, 15).cast("int"))
        return good.when(near("phone_near"), 1).when(near("card_near", "account_near", "other_near"), 0)
    if kind == "account":
        return fails.when(value.rlike("^[A-Z]") | near("account_near"), 1).when(near("phone_near", "other_near"), 0)
    return fails.otherwise(1)


def passes(kind: str, value: Column) -> Column:
    if kind == "ip":
        return value.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$")
    if kind == "card":
        return passes_luhn(value)
    if kind == "phone":
        return F.length(digits(value)).between(9, 15)
    return F.lit(True)


def feature_values(kind: int, span: Column) -> list[Column]:
    """The FEATURES of a candidate."""
    value, before, after = span["value"], span["before"], span["after"]
    count = lambda members: F.length(value) - F.length(F.regexp_replace(value, F.lit(f"[{members}]"), F.lit("")))
    plain = undisguised("ip", value)
    return [
        F.lit(kind), F.length(value), count("0-9"), count("A-Za-z"), count(" "), count("-"), count("."), value.startswith("+"), count("()\\[\\]"),
        value.contains("@"), passes_luhn(value), passes("ip", plain), F.coalesce(F.substring(digits(value), 1, 1).try_cast("int"), F.lit(-1)),
        before.rlike("[a-z0-9]$"), after.rlike("^[a-z0-9]"), after.rlike("^[ -]?[0-9]"), before == "",
        checked(KINDS[kind], value), value.rlike(DISGUISE), value.rlike("[^ ][.] "),
        *[before.rlike(f"(?:{cue})") for cue in CUES.values()],
    ]


def candidates(text: Column, base: Column | None = None) -> Column:
    """What the generators propose: kind (its place in KINDS), start, end, features, and, given the base spans, label."""

    def of(kind: str, pattern: str, needs: str) -> Column:
        number = KINDS.index(kind)

        def candidate(span: Column) -> Column:
            features = F.array(*[v.cast("double") for v in feature_values(number, span)])
            known = [] if base is None else [label(kind, span, base).alias("label")]
            return F.struct(F.lit(number).alias("kind"), span["start"].alias("start"), span["end"].alias("end"), features.alias("features"), *known)

        return F.transform(found(text, pattern, needs), candidate)

    return F.array_distinct(F.concat(*[of(*generator) for generator in GENERATORS]))


def base_spans(text: Column) -> Column:
    """Matches of the base patterns that pass: kind, start, end, by start and kind."""

    def of(kind: str, pattern: str) -> Column:
        matches = F.filter(found(text, pattern, NEEDS[kind]), lambda span: passes(kind, span["value"]))
        return F.transform(matches, lambda s: F.struct(s["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind"), s["end"].alias("end")))

    return F.sort_array(F.concat(*[of(*pattern) for pattern in BASE.items()]))


def inside(span: Column, spans: Column) -> Column:
    return F.exists(spans, lambda other: (other["start"] <= span["start"]) & (span["end"] <= other["end"]))


def proposed(docs: DataFrame, text: str = "text", labels: bool = False) -> DataFrame:
    """Adds `_base` and `_candidates`."""
    whole = F.coalesce(F.col(text), F.lit(""))
    return docs.withColumn("_base", base_spans(whole)).withColumn("_candidates", candidates(whole, F.col("_base") if labels else None))


class Model:
    """Trees, and the lowest score of each kind at which a candidate is taken."""

    def __init__(self, fitted: trees.Trees | None, thresholds: dict[int, float]):
        self.fitted, self.thresholds = fitted, thresholds

    def sql(self, candidate: str) -> str:
        """Whether a candidate is taken, as an SQL expression over its struct."""
        if self.fitted is None or not self.thresholds:
            return "false"
        score = self.fitted.sql(f"{candidate}.features")
        least = " ".join(f"when {kind} then {limit!r}D" for kind, limit in self.thresholds.items())
        return f"({score}) >= (case {candidate}.kind {least} end)"


def labelled(docs: DataFrame, text: str = "text") -> DataFrame:
    """What can be learnt from the documents and the examples: kind, features and label of candidates, equal ones once."""
    lines = "\n".join(around.format(value) for value in EXAMPLES for around in AROUND_EXAMPLES)
    fixed = docs.sparkSession.range(1).select(F.explode(F.split(F.lit(lines), "\n")).alias(text), F.lit(True).alias("_example"))
    rows = proposed(docs.select(text, F.lit(False).alias("_example")).unionByName(fixed), text, labels=True)
    # not explode: Spark adds a filter for it and pushes that below, where all is computed again, base spans per candidate
    rows = rows.select(F.col("_example").alias("example"), F.explode_outer("_candidates").alias("c"))
    return rows.select("example", "c.kind", "c.features", "c.label").where("label is not null").distinct()


def train(docs: DataFrame, text: str = "text") -> Model:
    """Fit on the candidates of all documents and on the examples; every fourth candidate of the documents, by a hash, is
    held out, and all of those give the thresholds. Up to ON_DRIVER candidates are fitted in one place, more on Spark."""
    place, folder = F.xxhash64("kind", "features", "label"), scratch(docs.sparkSession, "candidates")
    known = keep(labelled(docs, text).withColumn("place", place), f"{folder}/known")
    if known.count() > ON_DRIVER:
        return train_on_spark(known, folder)
    sample = sorted(known.collect(), key=lambda r: (r.example, r.place, r.label))  # sums, and so trees, don't depend on the order of arrival
    x, y = np.array([r.features for r in sample], float), np.array([r.label for r in sample], float)
    kinds, example = np.array([r.kind for r in sample]), np.array([r.example for r in sample])
    held = ~example & (np.array([r.place for r in sample]) % 4 == 0)
    times = np.where(example, EXAMPLE_WEIGHT, 1)[~held]
    fitted = trees.fit(np.repeat(x[~held], times, axis=0), np.repeat(y[~held], times), **TREES)
    return Model(fitted, {kind: threshold(fitted.raw(x[held & (kinds == kind)]), y[held & (kinds == kind)]) for kind in range(len(KINDS))})


def train_on_spark(known: DataFrame, folder: str) -> Model:
    held = ~F.col("example") & (F.pmod("place", F.lit(4)) == 0)
    times = F.when(F.col("example"), EXAMPLE_WEIGHT).otherwise(1)
    fitted = trees.fit_table(known.where(~held).select("features", "label", times.alias("times")), lambda df, name: keep(df, f"{folder}/{name}"), **TREES)
    scored = known.where(held).groupBy("kind", F.expr(fitted.sql("features")).alias("raw")).agg(F.count("*").alias("n"), F.sum("label").alias("good"))
    return Model(fitted, thresholds(keep(scored, f"{folder}/scores")))


def thresholds(scored: DataFrame) -> dict[int, float]:
    """What `threshold` gives, per kind, from a table of any size: kind, raw, n and good, a row per score. Scores are dealt
    by size into parts, whose sums the driver adds up; within its part, each score is counted on."""
    scored = scored.withColumn("part", F.floor(F.col("raw") * PARTS))
    parts = scored.groupBy("kind", "part").agg(F.sum("n").alias("n"), F.sum("good").alias("good")).collect()
    above, sums = [], {kind: (0, 0) for kind in range(len(KINDS))}
    for r in sorted(parts, key=lambda r: -r.part):
        above.append((r.kind, r.part, *sums[r.kind]))
        sums[r.kind] = sums[r.kind][0] + r.n, sums[r.kind][1] + r.good
    higher = F.broadcast(scored.sparkSession.createDataFrame(above, "kind int, part long, n_above long, good_above long"))
    on = Window.partitionBy("kind", "part").orderBy(F.desc("raw"))
    n, good = (F.sum(name).over(on) + F.col(f"{name}_above") for name in ("n", "good"))
    right = scored.join(higher, ["kind", "part"]).select("kind", "raw", ((good + 1) / (n + 2)).alias("share")).where((F.col("share") >= PRECISION) & (F.col("raw") > 0))
    least = {r.kind: r.least for r in right.groupBy("kind").agg(F.min("raw").alias("least")).collect()}
    return {kind: least.get(kind, FIXED) if n >= LEAST_HELD else FIXED for kind, (n, _) in sums.items()}


def threshold(raw: np.ndarray, labels: np.ndarray) -> float:
    """The lowest score from which on the smoothed share of right ones is PRECISION; FIXED if there are too few, or none."""
    if len(raw) < LEAST_HELD:
        return FIXED
    order = np.argsort(-raw, kind="stable")
    scores, right = raw[order], labels[order]
    share = (np.cumsum(right) + 1) / (np.arange(1, len(right) + 1) + 2)
    last = np.concatenate([scores[1:] != scores[:-1], [True]])  # equal scores stand or fall together
    good = np.flatnonzero((share >= PRECISION) & last & (scores > 0))
    return float(scores[good[-1]]) if len(good) else FIXED


def scan(docs: DataFrame, model: Model, text: str = "text", spans: str = "pii") -> DataFrame:
    """Adds the spans of every whole text by start and kind: kind, start, end, base. A given column of that name is
    replaced, all others stay."""
    rows = proposed(without(docs, spans), text)
    taken = rows.withColumn("_taken", F.expr(f"filter(_candidates, c -> {model.sql('c')})"))
    base = F.col("_base")
    # neither what a base span holds, nor a part of a longer candidate
    wider = lambda c, other: (other["start"] <= c["start"]) & (c["end"] <= other["end"]) & (other["end"] - other["start"] > c["end"] - c["start"])
    added = F.filter("_taken", lambda c: ~inside(c, base) & ~F.exists("_taken", lambda other: wider(c, other)))
    named = lambda spans, given: F.transform(
        spans, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"), F.lit(given).alias("base"))
    )
    both = F.sort_array(F.concat(named(base, True), named(F.array_distinct(added), False)))
    kinds = F.array(*[F.lit(kind) for kind in KINDS])
    full = F.transform(both, lambda s: F.struct(F.get(kinds, s["kind"]).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["base"].alias("base")))
    return taken.withColumn(spans, full).drop("_base", "_candidates", "_taken")


def listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def digests(docs: DataFrame) -> DataFrame:
    """Per document: base spans of each kind, a digest of the base spans, and all spans."""
    given = docs.select("doc_id", "text")
    rows = scan(given, train(given)).drop("text")
    base = F.filter("pii", lambda s: s["base"])
    count = lambda kind: F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long")
    return rows.select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in BASE],
        F.sha2(listed(base), 256).alias("base_sha256"),
        listed(F.col("pii")).alias("spans"),
    )
