"""Every operator on nulls, empty and long texts, repeated rows, empty tables and clashing columns."""

from __future__ import annotations

import re
import struct
from collections import Counter

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from rollcall.llm import bpe, classifier, decontaminate, html_text, jaccard, pii, rules, secret_scan, token_store, warc
from rollcall.llm.shared import scratch

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "a" * 200_000 + " " + "word " * 30_000 + "\n" * 1000 + "1" * 5000


@pytest.fixture(scope="module")
def odd(spark):
    rows = [
        (1, None, None, None, None),
        (2, "", "en", "s", 0),
        (3, " \n\t ", "en", "s", 4),
        (None, "text without an id of more than five words", "en", "s", 3),
        (4, LONG, "en", "s", len(LONG)),
        (5, "the same row twice, with some words", "en", "s", 9),
        (5, "the same row twice, with some words", "en", "s", 9),
        (6, "ends with <|endoftext|> and wide　space  ", None, "s", 1),
    ]
    return spark.createDataFrame(rows, DOCS).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


LABELS = "doc_id long, quality int, toxic int"
ITEMS = "item_id long, text string"


def clashing(docs, *names):
    """The table with columns of the names that an operator adds, in another case."""
    return docs.select("*", *[F.lit("mine").alias(name.upper()) for name in names])


def test_bpe(odd, none):
    rows = bpe.decode(bpe.encode(odd, TOKENIZER), TOKENIZER).collect()
    assert len(rows) == odd.count()
    assert all(r.decoded == (r.text or "") for r in rows)
    assert all((r.ids == b"") == (not r.text) for r in rows)
    assert bpe.digests(none, TOKENIZER).count() == 0
    both = clashing(odd, "ids", "decoded")
    again = bpe.decode(bpe.encode(both, TOKENIZER), TOKENIZER)
    assert again.columns == [*odd.columns, "ids", "decoded"]
    assert all(r.decoded == (r.text or "") for r in again.collect())


def test_secrets(odd, none, spark):
    assert all(r.spans == ("hex:0:200000,hex:351001:356001" if r.doc_id == 4 else "") for r in secret_scan.digests(odd).collect())
    assert secret_scan.digests(none).count() == 0
    clash = clashing(odd, "secrets")
    assert secret_scan.scan(clash).columns == [*odd.columns, "secrets"]
    kept = secret_scan.redacted(clash, length="n_chars")
    assert kept.columns == clash.columns
    assert sorted(map(str, kept.where("doc_id <> 4 or doc_id is null").collect())) == sorted(map(str, clash.where("doc_id <> 4 or doc_id is null").collect()))
    changed = kept.where("doc_id = 4").first()
    assert changed.text == LONG.replace("a" * 200_000, "[SECRET]").replace("1" * 5000, "[SECRET]") and changed.n_chars == len(changed.text)
    long = spark.createDataFrame([(1, "password = " + "x" * 100_000 + " é " + "0123456789abcdef" * 4000)], "doc_id long, text string")
    assert secret_scan.digests(long).first().spans.split(",")[0] == "assign:0:100011"


@pytest.mark.parametrize("few", [10**6, 0])
def test_decontamination(odd, none, spark, few):
    items = spark.createDataFrame([(None, "text without an id of more than five words"), (1, None), (2, "too short"), (3, ""), (4, "same row twice with some words"), (4, "same row twice with some words")], ITEMS)
    found = sorted((str(r.doc_id), str(r.item_id)) for r in decontaminate.overlaps(odd, items, broadcast_seeds=few).collect())
    assert found == [("5", "4"), ("None", "None")]
    clash = clashing(odd, "doc", "words", "seed", "item")
    kept = decontaminate.clean(clash, items)
    assert kept.columns == clash.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "2", "3", "4", "6"]
    assert decontaminate.overlaps(none, items, broadcast_seeds=few).count() == 0
    assert decontaminate.overlaps(odd, items.limit(0), broadcast_seeds=few).count() == 0
    assert decontaminate.clean(odd, spark.createDataFrame([], ITEMS)).count() == odd.count()


@pytest.mark.parametrize("few", [10**6, 0])
def test_short_items_are_found_by_all_their_words(spark, few):
    docs = spark.createDataFrame([(1, "Alpha beta. Gamma"), (2, "beta alpha gamma"), (3, "alpha"), (4, "x alpha beta gamma delta y"), (5, None)], "doc_id long, text string")
    items = spark.createDataFrame([(1, "alpha"), (2, "alpha beta"), (3, "alpha beta gamma"), (4, "alpha beta gamma delta"), (5, "delta!"), (6, "gamma alpha")], ITEMS)
    found = sorted(tuple(r) for r in decontaminate.overlaps(docs, items, broadcast_seeds=few).collect())
    assert [r[:2] for r in found] == [(1, 1), (1, 2), (1, 3), (2, 1), (3, 1), (4, 1), (4, 2), (4, 3), (4, 4), (4, 5)]
    assert all(r[2] == r[3] == r[4] for r in found)


def test_shuffled_seeds_find_the_same_and_carry_no_text(spark, tables):
    docs, items = (spark.read.parquet(f"{tables}/{name}.parquet") for name in ("documents", "benchmark"))
    few, many = (decontaminate.overlaps(docs, items, broadcast_seeds=n) for n in (10**6, 0))
    assert sorted(map(tuple, few.collect())) == sorted(map(tuple, many.collect()))
    plan = many._jdf.queryExecution().optimizedPlan().toString()
    assert re.search(r"Project \[seed#\d+L, doc#\d+L, copy#\d+L, at#\d+\]", plan)


def test_jaccard(odd, none):
    rows = sorted((str(r.doc_id), r.n_shingles, r.component_id) for r in jaccard.components(clashing(odd, "doc", "n", "label")).collect())
    sizes = {name: n for name, n, _ in rows}
    assert [name for name, *_ in rows] == ["1", "2", "3", "4", "5", "5", "6", "None"]
    assert (sizes["1"], sizes["2"], sizes["3"], sizes["5"], sizes["None"]) == (0, 0, 0, 3, 5)
    assert all(component == (None if name == "None" else int(name)) for name, _, component in rows)
    assert jaccard.components(none).count() == 0
    kept = jaccard.representatives(clashing(odd, "_again", "count"))
    assert kept.columns == [*odd.columns, "_AGAIN", "COUNT"]
    # of the row that is there twice, one stays
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "2", "3", "4", "5", "6", "None"]


def test_repeated_rows_go_from_the_groups(spark):
    text = "one two three four five six seven eight"
    rows = [(1, text), (1, text), (1, text + " nine ten eleven twelve"), (2, text), (3, "other"), (3, "other"), (3, None), (3, None), (None, "x"), (None, "x")]
    kept = jaccard.representatives(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(str, map(tuple, kept))) == sorted(map(str, [(1, text), (1, text + " nine ten eleven twelve"), (3, "other"), (3, None), (None, "x"), (None, "x")]))


def test_html(spark, none):
    pages = spark.createDataFrame([(1, None, None, "x"), (2, "", "", "x"), (2, "u", "<p>one</p>", "x"), (2, "u", "<p>one</p>", "x"), (None, "u", "<article>" + "<p>many words " * 20_000, "x")], "page_id long, url string, html string, TEXT string")
    rows = html_text.extract(pages).collect()
    assert sorted(len(r.text) for r in rows) == [0, 0, 3, 3, 20_000 * len("many words ") - 1]
    assert html_text.extract(pages).columns == ["page_id", "url", "html", "text"]
    assert html_text.texts(pages.limit(0)).count() == 0


def test_rules(odd, none):
    rows = {str(r.doc_id): r for r in rules.verdicts(clashing(odd, "n_words", "failed")).collect()}
    assert [rows[i].n_words for i in "123"] == [0, 0, 0]
    assert all(rows[i].base_failed and not rows[i].kept for i in "123")
    assert rows["4"].n_words == 30_002
    assert rows["4"].n_repeat_words == 30_000
    assert rules.verdicts(none).count() == 0
    assert rules.ablations(rules.ledger(none), rules.FULL).count() == 0


def test_warc(spark):
    schema = "page_id long, url string, time timestamp, html string, PAYLOAD string, record_type string"
    rows = [
        (1, None, None, None, "m", "m"), (2, "", None, "", "m", "m"), (3, "http://a.example/\r\nX: y", None, "x" * 300_000, "m", "m"),
        (None, "not a url [", None, "", "m", "m"), (5, "http://a.example/ü", None, "same", "m", "m"), (5, "http://a.example/ü", None, "same", "m", "m"),
        (4, "http://a.example/v", None, "same", "m", "m"),
    ]
    found = warc.history(spark.createDataFrame(rows, schema)).collect()
    by = sorted((str(r.page_id), r.payload_bytes, r.record_type, r.refers_to) for r in found)
    assert by == [
        ("1", 0, "revisit", 2), ("2", 0, "response", None), ("3", 300_000, "response", None), ("4", 4, "revisit", 5),
        ("5", 4, "response", None), ("5", 4, "response", None), ("None", 0, "revisit", 2),
    ]
    assert warc.history(spark.createDataFrame([], schema)).count() == 0


def test_token_store(spark, odd, none):
    found = [(r.doc_id, r.start, r.n_tokens) for r in token_store.checks(clashing(odd, "key", "shard", "at", "copy"), scratch(spark, "store"), TOKENIZER, 2).collect()]
    found.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    assert [d for d, *_ in found] == [1, 2, 3, 4, 5, 5, 6, None]  # rows without an id come last
    assert [n for _, _, n in found][:2] == [1, 1]
    assert [s for _, s, _ in found] == [sum(n for *_, n in found[:i]) for i in range(len(found))]
    assert token_store.checks(none, scratch(spark, "store"), TOKENIZER, 2).count() == 0


def test_token_store_with_keys_that_span_shards(spark, parted):
    """Most rows have one key, or none, many of them the same text; each asked for as often as it is there."""
    rows = [(7 if i % 3 == 0 else None if i % 3 == 1 else i, f"text {i % 5 if i % 2 else 0}") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    folder = scratch(spark, "store")
    token_store.write(docs, folder, TOKENIZER, 2)
    assert spark.read.parquet(f"{folder}/shards.parquet").count() > 2
    read = token_store.read(spark, folder, docs.select("doc_id")).collect()
    tokenizer = Tokenizer.from_file(TOKENIZER)
    ids = lambda text: tuple([*tokenizer.encode(text, add_special_tokens=False).ids, 2])
    wanted = Counter((doc, ids(text)) for doc, text in rows)
    assert Counter((r.doc_id, struct.unpack(f"<{r.n_tokens}I", r.ids)) for r in read) == wanted
    in_order = sorted(read, key=lambda r: r.start)
    assert [r.start for r in in_order] == [sum(r.n_tokens for r in in_order[:i]) for i in range(len(in_order))]
    assert [r.doc_id for r in in_order] == sorted([d for d, _ in rows], key=lambda d: (d is None, d or 0))
    unknown = spark.createDataFrame([(7,), (-1,), (None,)], "doc_id long")
    assert sorted(str(r.doc_id) for r in token_store.read(spark, folder, unknown).collect()) == ["7", "None"]


def test_classifier(spark, odd, none):
    labels = spark.createDataFrame([(1, 1, None), (2, None, 0), (4, 0, 0), (5, 1, 0), (5, 0, 0), (77, 1, 1), (None, 1, 1), (6, 3, 0)], LABELS)
    rows = classifier.predictions(clashing(odd, "score", "label"), labels).collect()
    assert len(rows) == odd.count()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    assert classifier.predictions(none, labels).count() == 0
    unlearned = classifier.predictions(odd, labels.limit(0)).collect()
    assert {r.score for r in unlearned} == {0.5}
    clash = clashing(odd, "score")
    assert classifier.accepted(clash, labels).columns == clash.columns


def test_pii(odd, none, spark):
    assert all(r.spans == "" for r in pii.digests(odd).collect())
    assert pii.digests(none).count() == 0
    assert pii.scan(clashing(odd, "pii"), pii.Model(None, {})).columns == [*odd.columns, "pii"]
    text = "a.b@c.example " * 300 + "a" * 100_000 + "1 " * 20_000 + "+1" + " " * 50_000 + "x" + "1.1." * 3000
    row = pii.digests(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert row.n_email == 300
