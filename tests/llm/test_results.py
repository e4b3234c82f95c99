"""The numbered queries against brute-force versions over whole tables."""

from __future__ import annotations

import base64
import hashlib
import html
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from rollcall.llm import classifier, decontaminate, secret_scan
from rollcall.llm.queries import ORACLES, QUERIES, TOKENIZER


@pytest.fixture(scope="module")
def docs(spark, tables):
    return sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{tables}/documents.parquet").collect())


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(TOKENIZER)


def rows(spark, tables, name, key="doc_id"):
    return sorted(QUERIES[name](spark, tables).collect(), key=lambda r: r[key])


def digest(spans, kinds):
    return hashlib.sha256(",".join(f"{kinds[k]}:{a}:{b}" for a, k, b in spans).encode()).hexdigest()


def test_op1(spark, tables, docs, tokenizer):
    for (doc, text), row in zip(docs, rows(spark, tables, "op1_bpe"), strict=True):
        ids = tokenizer.encode(text, add_special_tokens=False).ids
        decoded = tokenizer.decode(ids, skip_special_tokens=False)
        assert row.doc_id == doc and row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()


def secrets_of(text):
    patterns = (
        (r"""((?:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
        (r"AKIA[A-Z0-9]+", 0, 16),
        (r"[0-9a-f]+", 0, 32),
    )
    return sorted(
        (m.start(), k, m.end())
        for k, (pattern, group, least) in enumerate(patterns)
        for m in re.finditer(pattern, text, re.ASCII | (re.IGNORECASE if k == 0 else 0))
        if len(m[group]) >= least
    )


def test_op2(spark, tables, docs):
    for (_, text), row in zip(docs, rows(spark, tables, "op2_secret_scan"), strict=True):
        spans = secrets_of(text)
        assert [row.n_assign, row.n_access, row.n_hex] == [sum(s[1] == k for s in spans) for k in range(3)]
        assert row.base_sha256 == digest(spans, secret_scan.KINDS)
        assert {f"{secret_scan.KINDS[k]}:{a}:{b}" for a, k, b in spans} <= set(row.spans.split(",")) | {""}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, tables, name):
    result = QUERIES[name](spark, tables)
    columns = sorted(result.columns)
    found = sorted(str([row[c] for c in columns]) for row in result.collect())
    with duckdb.connect() as db:
        for given in ("documents", "benchmark", "conversations"):
            db.sql(f"create view {given} as select * from '{tables}/{given}.parquet'")
        wanted = db.sql(ORACLES[name])
        assert sorted(wanted.columns) == columns
        assert found == sorted(str([row[wanted.columns.index(c)] for c in columns]) for row in wanted.fetchall())


def shingle_set(text):
    words = text.encode().lower().split()
    return frozenset([tuple(words[i : i + 5]) for i in range(len(words) - 4)] if len(words) > 4 else [tuple(words)] if words else [])


def brute_components(docs):
    sets, parent = {doc: shingle_set(text) for doc, text in docs}, {doc: doc for doc, _ in docs}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    met = defaultdict(set)
    for doc, s in sets.items():
        for shingle in s:
            for other in met[shingle]:
                if top(doc) != top(other):
                    both = len(s & sets[other])
                    if 100 * both >= 75 * (len(s) + len(sets[other]) - both):
                        a, b = sorted((top(doc), top(other)))
                        parent[b] = a
            met[shingle].add(doc)
    return {doc: (len(sets[doc]), top(doc)) for doc in sets}


def test_op4(spark, tables, docs):
    wanted = brute_components(docs)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows(spark, tables, "op4_jaccard")} == wanted


def test_op5(spark, tables):
    pages = {r.page_id: r for r in spark.read.parquet(f"{tables}/pages.parquet").collect()}
    for row in rows(spark, tables, "op5_html_text", "page_id"):
        page = pages[row.page_id].html
        article = page[page.index("<article>") :].split("</article>")[0]
        wanted = " ".join(html.unescape(re.sub(r"<[a-zA-Z/!][^>]*(?:>|\Z)|</?\Z", " ", article)).split())
        assert (row.url, row.text, row.n_chars) == (pages[row.page_id].url, wanted, len(wanted))


def test_op7(spark, tables):
    pages = sorted((r.page_id, (r.html or "").encode()) for r in spark.read.parquet(f"{tables}/pages.parquet").collect())
    last = {payload: page for page, payload in pages}
    for (page, payload), row in zip(pages, rows(spark, tables, "op7_warc", "page_id"), strict=True):
        original = last[payload] if last[payload] != page else None
        assert (row.page_id, row.payload_bytes, row.refers_to) == (page, len(payload), original)
        assert row.payload_digest == base64.b32encode(hashlib.sha1(payload).digest()).decode()
        assert row.record_type == ("response" if original is None else "revisit")


def test_op8(spark, tables, docs, tokenizer):
    start = 0
    for (doc, text), row in zip(docs, rows(spark, tables, "op8_token_store"), strict=True):
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 2]
        assert (row.doc_id, row.start, row.n_tokens) == (doc, start, len(ids))
        assert row.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)


def test_op9(spark, tables):
    folder = tables.replace("0.001", "0.01")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    found = QUERIES["op9_classifier"](spark, folder).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in found)
    held = [(r.predicted, labels[r.doc_id]) for r in found if r.held_out and r.doc_id in labels]
    assert len(held) > 50
    assert sum(p == q for p, q in held) >= 0.95 * len(held)


def luhn(value):
    digits = [int(c) for c in reversed(re.sub(r"[^0-9]", "", value))]
    return 12 <= len(digits) <= 19 and sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(digits)) % 10 == 0


def test_op10(spark, tables, docs):
    kinds = ("email", "ip", "card", "phone")
    patterns = (
        (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda v: True),
        (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda v: all(int(p) <= 255 for p in v.split("."))),
        (r"[0-9]([ -]?[0-9])+", luhn),
        (r"\+[0-9][ ().0-9-]+[0-9]", lambda v: 9 <= len(re.sub(r"[^0-9]", "", v)) <= 15),
    )
    for (_, text), row in zip(docs, rows(spark, tables, "op10_pii"), strict=True):
        spans = sorted((m.start(), k, m.end()) for k, (p, passes) in enumerate(patterns) for m in re.finditer(p, text) if passes(m[0]))
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == [sum(s[1] == k for s in spans) for k in range(4)]
        assert row.base_sha256 == digest(spans, kinds)
        assert {f"{kinds[k]}:{a}:{b}" for a, k, b in spans} <= set(row.spans.split(",")) | {""}


def test_pipeline(spark, tables, docs, tokenizer):
    """Each stage's decision, made here in plain Python on what the stage before left."""
    given = spark.read.parquet(f"{tables}/documents.parquet")
    model = classifier.train(given, spark.read.parquet(f"{tables}/labels.parquet"))
    good = {r.doc_id for r in classifier.scored(given, model).collect() if r.score >= classifier.THRESHOLD}
    left = [(doc, text) for doc, text in docs if doc in good]
    groups = brute_components(left)
    left = [(doc, text) for doc, text in left if groups[doc][1] == doc]
    words = lambda text: re.findall(r"[^\W_]+", text.lower())
    items = [words(r.text) for r in spark.read.parquet(f"{tables}/benchmark.parquet").collect()]

    def leaks(text):
        mine = words(text)
        at = defaultdict(list)
        for place, word in enumerate(mine):
            at[word].append(place)
        for item in items:
            width = min(len(item), decontaminate.WINDOW)
            offsets = Counter(place - i for i, word in enumerate(item) for place in at[word])
            for offset, count in offsets.items():
                if 13 * count >= 10 * width:
                    equal = [0 <= offset + i < len(mine) and mine[offset + i] == word for i, word in enumerate(item)]
                    if any(13 * sum(equal[i : i + width]) >= 10 * width for i in range(len(item) - width + 1)):
                        return True
        return False

    left = [(doc, text) for doc, text in left if not leaks(text)]
    found = {r.doc_id: r for r in corpus_pipeline.run(spark, tables).collect()}
    assert sorted(found) == [doc for doc, _ in left]
    for doc, text in left:
        spans, out, end = sorted((s["start"], s["end"]) for s in secret_scan.found(text.encode())), "", 0
        for a, b in spans:
            out, end = out + (text[end:a] + "[SECRET]" if a >= end else ""), max(end, b)
        text = out + text[end:]
        assert found[doc].text == text
        assert np.frombuffer(found[doc].ids, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids
        assert not spans or found[doc].n_chars == len(text)
