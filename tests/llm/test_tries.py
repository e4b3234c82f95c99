"""The prefix trie, SuperMinHash and the Merkle manifest against brute force, and their methods by themselves."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from rollcall.llm import merkle, prefix_trie, superminhash
from rollcall.llm.perfect_hash import mixed
from rollcall.llm.prefix_trie import WIDTH
from rollcall.llm.radix_tree import Direct, Indexed, RadixTree, Sorted, common
from rollcall.llm.shared import scratch
from rollcall.llm.van_emde_boas import addresses, size
from rollcall.llm.words import shingles

TURNS = "conv_id long, turn long, role string, text string"


# ---- radix trees


def listed(node, start=b""):
    here = start + node.path
    found = [] if node.value is None else [(here, node.value)]
    for byte in range(256):
        if (kid := node.child(byte)) is not None:
            found += listed(kid, here + bytes([byte]))
    return found


@pytest.mark.parametrize("seed", range(5))
def test_radix_tree_holds_all_keys_in_order(seed):
    rng = random.Random(seed)
    keys = {bytes(rng.choices(range(rng.choice([2, 20, 256])), k=rng.randrange(6))) for _ in range(3000)}
    tree = RadixTree()
    for key in rng.sample(sorted(keys), len(keys)):
        tree.insert(key, key or b"empty")
    assert listed(tree.root) == [(key, key or b"empty") for key in sorted(keys)]


@pytest.mark.parametrize(("count", "layout", "room"), [(1, Sorted, 4), (4, Sorted, 4), (5, Sorted, 16), (16, Sorted, 16), (17, Indexed, None), (48, Indexed, None), (49, Direct, None), (256, Direct, None)])
def test_layouts_grow(count, layout, room):
    tree = RadixTree()
    order = random.Random(count).sample(range(256), count)
    for byte in order:
        tree.insert(b"same" + bytes([byte]) + b"rest", byte + 1)
    if count > 1:
        assert tree.root.path == b"same"
        assert type(tree.root.kids) is layout and getattr(tree.root.kids, "room", None) == room
        assert [node.value - 1 for node in tree.root.children()] == sorted(order)
    assert common(b"abc", b"abd") == 2 and common(b"", b"x") == 0 and common(b"\x00a", b"\x00") == 1


# ---- the trie


def built(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, (role or "", text or "")))
    own = {conv: [x[2] for x in sorted(turns, key=lambda x: x[:2])] for conv, turns in own.items()}
    made = {}
    for conv, turns in own.items():
        h = zlib.crc32(str(conv).encode()) % 4
        made[conv] = own.get(conv - conv % 20, [])[:h] + turns[h:]
    return made


def brute_trie(made):
    members, ended = defaultdict(list), defaultdict(list)
    for conv, turns in made.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(conv)
        ended[tuple(turns)].append(conv)
    kids = defaultdict(set)
    for prefix in members:
        if prefix:
            kids[prefix[:-1]].add(prefix)
    leaves, saved = defaultdict(int), defaultdict(int)
    for prefix, convs in members.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", prefix[-1][1])) if prefix else 0
        for d in range(len(prefix) + 1):
            leaves[prefix[:d]] += not kids[prefix]
            saved[prefix[:d]] += (len(convs) - 1) * words
    return sorted(
        (
            min(convs), len(prefix), min(members[prefix[:-1]]) if prefix else None, len(convs), len(kids[prefix]), leaves[prefix], saved[prefix],
            hashlib.sha256(",".join(map(str, sorted(ended[prefix]))).encode()).hexdigest(),
        )
        for prefix, convs in members.items()
    )


def crowd(seed, convs=400):
    """Conversations that share much: few texts, all lengths, one conversation very often."""
    rng = random.Random(seed)
    rows = []
    for conv in range(convs):
        turns = ["hot first turn", "b b", "c"] if conv % 3 == 0 else rng.choices(["a", "b b", "c c\tc", "", "hot first turn"], k=rng.randrange(6))
        rows += [(conv, turn, rng.choice(["user", "user", None]) if conv % 3 else "user", text or None) for turn, text in enumerate(turns)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("keys", [1, 3, 7, 20_000])
def test_trie_in_trees_of_any_size(spark, parted, keys):
    rows = crowd(keys)
    convs = prefix_trie.rebuilt(prefix_trie.gathered(spark.createDataFrame(rows, TURNS)))
    found = prefix_trie.nodes(convs, scratch(spark, "trie"), keys).collect()
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, brute_trie(built(rows))))


def test_trie_of_the_table(spark, tables):
    rows = [tuple(r) for r in spark.read.parquet(f"{tables}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    found = prefix_trie.trie(spark.read.parquet(f"{tables}/conversations.parquet"))
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, brute_trie(built(rows))))


def test_trie_of_odd_rows(spark):
    long = "word " * 50_000
    rows = [
        (None, 0, "user", "no conversation"), (1, None, None, None), (1, 0, "user", long), (1, 0, "user", long), (2, 1, "", ""),
        (3, 5, "user", "x"), (20, 0, "user", "base"), (25, 0, "user", "own"), (41, 0, "user", "one turn only"), (4, None, "", None),
    ]
    given = spark.createDataFrame(rows, TURNS).selectExpr("*", "'mine' as ID", "1 as WORDS", "'x' as seq")
    found = prefix_trie.trie(given)
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, brute_trie(built(rows))))
    assert prefix_trie.trie(given.limit(0)).count() == 0
    # every conversation without a turn of its own: only the root
    alone = spark.createDataFrame([(c, 0, "user", "x") for c in range(1, 20) if zlib.crc32(str(c).encode()) % 4], TURNS)
    (root,) = prefix_trie.trie(alone).collect()
    assert (root.depth, root.n_leaves, root.n_children, root.saved_tokens, root.parent_conv_id) == (0, 1, 0, 0, None)


def test_ids_of_a_key_with_most_conversations(spark, parted):
    """More ids than a piece holds, over several tasks."""
    many = 3 * prefix_trie.IDS + 17
    convs = spark.range(0, many).selectExpr("id * 7 as conv_id", "cast(cast(if(id % 3 = 0, id, 5) as string) as binary) as seq")
    by = defaultdict(list)
    for conv, seq in ((r.conv_id, bytes(r.seq)) for r in convs.collect()):
        by[seq].append(conv)
    found = {bytes(r.seq): (r.n, r.least, r.ends) for r in prefix_trie.ends(convs, scratch(spark, "ends")).collect()}
    assert found == {seq: (len(ids), min(ids), hashlib.sha256(",".join(map(str, sorted(ids))).encode()).hexdigest()) for seq, ids in by.items()}


def test_names_of_nodes_are_digests_of_prefixes():
    key = bytes(range(3 * WIDTH % 256)) + bytes(3 * WIDTH)
    key = key[: 3 * WIDTH]
    assert prefix_trie.digests(key, 2) == [hashlib.blake2b(key[: d * WIDTH], digest_size=16).digest() for d in range(3)]


# ---- SuperMinHash


def one_by_one(elements, places):
    """The published algorithm, an element after the other, with the operator's random numbers."""
    best = [2**64 - 1] * places
    for element in elements:
        order = list(range(places))
        for step in range(places):
            x = int(mixed(np.array([element], np.uint64), 31 + step)[0])
            k = step + ((x >> 32) * (places - step) >> 32)
            order[step], order[k] = order[k], order[step]
            best[order[step]] = min(best[order[step]], step << 32 | x & 0xFFFFFFFF)
    return best


def test_signatures_are_those_of_the_sequential_algorithm():
    rng = np.random.default_rng(1)
    counts = np.array([0, 1, 3, 40, 400, 0, 25])
    elements = rng.integers(0, 2**63, counts.sum()).astype(np.uint64)
    ends = np.cumsum(counts)
    found = superminhash.signatures(elements, counts, 24)
    for row, a, b in zip(found.tolist(), ends - counts, ends, strict=True):
        assert row == one_by_one(elements[a:b].tolist(), 24)


def test_signatures_estimate_similarity_with_less_variance():
    rng = np.random.default_rng(2)
    errors = []
    for _ in range(60):
        x = rng.integers(0, 2**63, 60).astype(np.uint64)  # fewer elements than places: here ranks are most correlated
        y = np.concatenate([x[:48], rng.integers(0, 2**63, 12).astype(np.uint64)])
        a, b = superminhash.signatures(np.concatenate([x, y]), np.array([60, 60]))
        errors.append((a == b).mean() - 48 / 72)
    assert abs(np.mean(errors)) < 0.01
    assert np.var(errors) < 0.9 * (48 / 72) * (24 / 72) / superminhash.PLACES


def sets_of(text, size=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def brute_groups(texts):
    """texts: (id, text), ids may repeat."""
    ids = sorted({i for i, _ in texts})
    up = {i: i for i in ids}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    sets = [(i, sets_of(t)) for i, t in texts]
    for n, (i, x) in enumerate(sets):
        for j, y in sets[:n]:
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                a, b = sorted((root(i), root(j)))
                up[b] = a
    return {i: root(i) for i in ids}


def copies(seed, count, rate, words=120):
    """A text, and copies in which each word is another at some rate."""
    rng = random.Random(seed)
    base = [f"w{rng.randrange(10**6)}" for _ in range(words)]
    return [" ".join(f"x{rng.randrange(10**9)}" if rng.random() < rate * (i % 10) / 10 else word for word in base) for i in range(count)]


def test_groups_in_crowded_buckets(spark):
    """Hundreds of copies around the threshold: buckets hold far more pairs than are compared one by one."""
    texts = list(enumerate(copies(1, 300, 0.12) + copies(2, 100, 0.03) + copies(3, 60, 0.5, 15)))
    assert 300 * 100 > superminhash.PAIRS
    found = {r.doc_id: r.component_id for r in superminhash.components(spark.createDataFrame(texts, "doc_id long, text string").repartition(5)).collect()}
    wanted = brute_groups(texts)
    assert found == wanted
    assert len(set(wanted.values())) > 40


def test_groups_of_odd_rows(spark):
    long = "long " + "a" * 200_000 + " " + "word " * 30_000
    texts = [
        (1, None), (2, ""), (3, " \n\t "), (4, long), (5, long + "end"), (6, "one two"), (7, "ONE\x0btwo"), (8, "One three"), (9, "a b c d e f"), (9, "a b c d e f"),
        (10, "A b c d e f"), (11, "alpha beta gamma delta epsilon zeta eta"), (11, "quite another text of seven words here"), (12, "Quite another text of seven words here"),
        (13, "alpha beta gamma delta epsilon zeta Eta"),
    ]
    rows = [(*x, "mine", 1) for x in [*texts, (None, "one two"), (None, "a b c d e f")]]
    given = spark.createDataFrame(rows, "doc_id long, text string, LABEL string, part int")
    found = superminhash.components(given).collect()
    assert len(found) == len(rows)
    wanted = brute_groups(texts)
    assert {r.doc_id: r.component_id for r in found if r.doc_id is not None} == wanted
    assert all(r.kept == (r.doc_id == r.component_id) for r in found if r.doc_id is not None)
    assert all(r.kept and r.component_id is None for r in found if r.doc_id is None)
    assert {r.doc_id: r.n_shingles for r in found}[3] == 0
    assert superminhash.components(given.limit(0)).count() == 0
    kept = superminhash.representatives(given)
    assert kept.columns == given.columns
    assert sorted({r.doc_id for r in kept.collect() if r.doc_id is not None}) == sorted(set(wanted.values()))


@pytest.mark.parametrize("count", range(1, 6))
def test_shingles_of_a_few_words_alone(count):
    """A batch may hold fewer words than a shingle."""
    texts = pa.array([" ".join("abcdefgh"[:count]), None, ""])
    for size in (1, 4, 5):
        made, counts = shingles(texts, size)
        assert counts.tolist() == [max(1, count - size + 1), 0, 0]
        alone = [shingles(pa.array([" ".join("abcdefgh"[i : i + size][: count - i])]), size)[0][0] for i in range(counts[0])]
        assert made.tolist() == alone


def test_union_find_folds_a_chain_inside_a_task(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(1000)], "a long, b long").coalesce(1)
    rows = superminhash.united(edges).collect()
    assert sorted(r.a for r in rows) == list(range(1, 1001)) and {r.b for r in rows} == {0}


# ---- the Merkle manifest


@pytest.mark.parametrize(("levels", "fan"), [(1, 3), (2, 3), (4, 3), (7, 3), (5, 2)])
def test_van_emde_boas_order(levels, fan):
    found = [addresses(levels, depth, np.arange(fan**depth), fan) for depth in range(levels)]
    assert sorted(np.concatenate(found).tolist()) == list(range(size(levels, fan)))
    assert found[0].tolist() == [0]
    upper = levels // 2
    if upper:  # the upper half lies before all trees below it, and each of those in one piece
        assert max(np.concatenate(found[:upper])) == size(upper, fan) - 1
        for tree in range(fan**upper):
            nodes = np.concatenate([x[tree * fan**d : (tree + 1) * fan**d] for d, x in enumerate(found[upper:])])
            assert max(nodes) - min(nodes) == size(levels - upper, fan) - 1


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return sha(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def climb(level):
    """All levels of a tree."""
    levels = [level]
    while len(levels[-1]) > 1:
        levels.append([sha(*levels[-1][i : i + 3]) for i in range(0, len(levels[-1]), 3)])
    return levels


def sides(levels, i):
    for level in levels[:-1]:
        start = i // 3 * 3
        yield level[start:i], level[i + 1 : start + 3]
        i //= 3


def brute_manifest(rows):
    """rows: (doc_id, source, lang, n_chars, text), by brute force; equal ids stand in the order of their leaves."""
    by = defaultdict(list)
    for row in rows:
        by[row[1]].append((row[0] is not None, row[0] or 0, leaf(row), row))
    names = sorted(by, key=lambda name: (name is not None, (name or "").encode()))
    trees = {name: climb([x[2] for x in sorted(by[name], key=lambda x: x[:3])]) for name in names}
    top = climb([trees[name][-1][0] for name in names])
    root = top[-1][0]
    found = []
    for at, name in enumerate(names):
        for i, (_, _, own, row) in enumerate(sorted(by[name], key=lambda x: x[:3])):
            way = [*sides(trees[name], i), *sides(top, at)]
            text = row[4]
            if row[0] is not None and text is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0:
                text = text.replace("\n", "")
            end = leaf((*row[:4], text))
            for before, after in way:
                end = sha(*before, end, *after)
            found.append((row[0], own, trees[name][-1][0], root, sha(*(x for before, after in way for x in (*before, *after))), end, end == root))
    return sorted(map(str, found))


DOCS = "doc_id long, source string, lang string, n_chars long, text string"


def test_manifest_of_the_table(spark, tables):
    given = spark.read.parquet(f"{tables}/documents.parquet")
    rows = [tuple(r) for r in given.select("doc_id", "source", "lang", "n_chars", "text").collect()]
    assert sorted(map(str, map(tuple, merkle.audited(given).collect()))) == brute_manifest(rows)


def test_manifest_over_many_blocks(spark, parted):
    """A source of several blocks, the last one short, beside sources of a full block, a block and one, and single rows."""
    counts = {"hot": 5 * merkle.BLOCK + 1, "full": merkle.BLOCK, "more": merkle.BLOCK + 1, None: 4, "": 1, "é": 2, "z": 1}
    rows = [(1000 * n + i, name, None, i, f"line\n{i}") for n, (name, count) in enumerate(counts.items()) for i in range(count)]
    random.Random(1).shuffle(rows)
    given = spark.createDataFrame(rows, DOCS).repartition(7)
    assert sorted(map(str, map(tuple, merkle.audited(given).collect()))) == brute_manifest(rows)


def test_manifest_over_many_sources(spark, parted):
    rows = [(i, f"s{i}", "en", 1, "a\nb") for i in range(merkle.BLOCK + 5)]
    found = merkle.audited(spark.createDataFrame(rows, DOCS).repartition(5)).collect()
    assert sorted(map(str, map(tuple, found))) == brute_manifest(rows)
    assert {r.verified for r in found} == {True, False}


def test_manifest_of_odd_rows(spark):
    long = "x\n" * 100_000
    rows = [
        (1, None, None, None, None), (None, "a", "en", 1, "no\nid"), (None, "a", "en", 1, "no\nid"), (2, "a", "en", 1, ""), (3, "a", "en", None, long),
        (3, "a", "en", None, long), (3, "a", "en", 7, "other"), (7, "b", None, 0, "é\n"),
    ]
    given = spark.createDataFrame(rows, DOCS).selectExpr("*", "'mine' as TREE", "1 as pos", "2 as `Block`", "3 as id")
    assert sorted(map(str, map(tuple, merkle.audited(given).collect()))) == brute_manifest(rows)
    assert merkle.audited(given.limit(0)).count() == 0
    (row,) = merkle.audited(given.where("doc_id = 7")).collect()
    assert row.leaf == row.subroot == row.root and row.proof_sha256 == sha("")
