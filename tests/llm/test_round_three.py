"""Token ids, packing, Merkle manifest and hard negatives against plain versions."""

import hashlib
import math
import os
import random
import re
import sys
import time
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

sys.path.insert(0, os.path.dirname(__file__))

import brute  # noqa: E402

from racelake.llm import decontam, hard_negatives, merkle, ngram_join, packing, pii, suffix_dedup, token_ids, topk  # noqa: E402

VOCABULARY = public_tokenizers.path(packing.VOCABULARY)
SPECIAL = "a <|endoftext|> b<|endoftext|>c"
TEXTS = [
    None, "", " ", "a", SPECIAL, "  two  gaps   and\n\n lines \n \t end ", "Ünï 日本　語 \xa0x\x85 y", "x" * 5000,
    "A LONG Text " * 900, "it's we'll <|endoftext|>  <|endoftext|>", "it's we'll <|endoftext|>  <|endoftext|>",
]


@pytest.fixture(scope="module")
def rows():
    out = [(i, t, f"s{i % 3}" if i % 4 else None, "en" if i % 2 else None, None if t is None else len(t)) for i, t in enumerate(TEXTS)]
    return [*out, out[8], (None, "no id A", "s1", None, 7), (8, "Another text of the same id", "s2", "de", None)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    shape = "doc_id long, text string, source string, lang string, n_chars long, key string, at long, length string"
    return spark.createDataFrame([(*r, "k", 7, "x") for r in rows], shape).repartition(3)


def plain_ids(text):
    return Tokenizer.from_file(VOCABULARY).encode(text or "", add_special_tokens=False).ids


# --- token ids ---


def test_token_ids_are_the_library_s():
    tokenizer = Tokenizer.from_file(VOCABULARY)
    draw = random.Random(7)
    parts = [" ", "  ", "\n", "\t", "a", "bc", "é", "日", "　", "\xa0", "\x85", " ", "​", "\x1c", "'s", "1", "!", "<|endoftext|>", "🙂", *[" "] * 8]
    texts = ["".join(draw.choice(parts) for _ in range(draw.randint(0, 40))) for _ in range(4000)] + TEXTS[1:]
    texts += ["w" * 300 + " and " + "v" * 300, "w" * 300]  # pieces that are not remembered, met twice
    for _ in range(2):
        ids, counts = token_ids.encode(pa.array(texts), VOCABULARY)
        found = np.split(ids, np.cumsum(counts)[:-1])
        assert [f.tolist() for f in found] == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_token_ids_of_slices_and_after_forgetting(monkeypatch):
    monkeypatch.setattr(token_ids, "STEP", 64)
    texts = pa.array([None if t is None else t[:200] for t in TEXTS] * 3)
    found, rows = [], 0
    for lo, hi in token_ids.slices(texts):
        ids, counts = token_ids.encode(texts.slice(lo, hi - lo), VOCABULARY, 5)
        found += ids.tolist()
        rows += len(counts)
        assert sum(counts) == len(ids)
    assert rows == len(texts) and found == [i for t in texts.to_pylist() for i in plain_ids(t)]


# --- packing ---


def test_decompose():
    for n in [*range(1, 70), 2048, 5000, 4096]:
        doc, start, length = packing.decompose(np.array([n]), 16)
        assert not doc.any() and length.sum() == n and (start == np.cumsum(length) - length).all()
        assert sorted(length, reverse=True) == length.tolist() and (length[length < 16]).tolist() == [2**b for b in (3, 2, 1, 0) if n % 16 >> b & 1]


def test_packing(spark, docs, rows, tmp_path):
    found = packing.pack(docs, VOCABULARY, 64).collect()
    want = sorted(tuple([*plain_ids(r[1]), 1]) for r in rows)
    by_doc = defaultdict(list)
    for r in found:
        assert r["length"] == len(r["ids"]) <= 64 and r["length"] & (r["length"] - 1) == 0 and r["offset"] == 0
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
        by_doc[r["doc_id"]].append(r)
    single = {r[0]: r for r in rows if sum(x[0] == r[0] for x in rows) == 1}
    for doc, row in single.items():
        pieces = sorted(by_doc[doc], key=lambda r: r["start"])
        whole = [*plain_ids(row[1]), 1]
        assert [i for p in pieces for i in p["ids"]] == whole and {p["doc_tokens"] for p in pieces} == {len(whole)}
        assert [p["start"] for p in pieces] == np.cumsum([0] + [p["length"] for p in pieces])[:-1].tolist()
    assert sum(r["length"] for r in found) == sum(map(len, want))  # repeated rows and rows of one id as well
    numbered = sorted(found, key=lambda r: r["sequence_id"])
    assert [r["sequence_id"] for r in numbered] == list(range(len(found)))
    assert [r["length"] for r in numbered] == sorted((r["length"] for r in found), reverse=True)
    packing.write(packing.pack(docs, VOCABULARY, 64), str(tmp_path / "packed"))
    bucket = packing.read(spark, str(tmp_path / "packed"), 16)
    assert bucket.count() == sum(r["length"] == 16 for r in found)
    assert "PartitionFilters: [isnotnull(length" in bucket._jdf.queryExecution().toString()


def test_packing_nothing(spark, docs):
    assert packing.pack(docs.filter("false"), VOCABULARY).count() == 0
    with pytest.raises(ValueError):
        packing.pack(docs, VOCABULARY, 100)


# --- Merkle manifest ---


def hexed(data):
    return hashlib.sha256(data).hexdigest()


def leaf_of(doc, text, source, lang, n):
    values = [None if v is None else str(v).encode() for v in (doc, source, lang, n, text)]
    return hexed(b"".join(b"-" if v is None else b"%d:" % len(v) + v for v in values))


def levels_of(row):
    out = [row]
    while len(row) > 1:
        row = [hexed("".join(row[i : i + 16]).encode()) for i in range(0, len(row), 16)]
        out.append(row)
    return out


def plain_proofs(rows):
    """(doc_id, leaf, subroot, root, proof, folded root, verified) of every row."""
    by = defaultdict(list)
    lower = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
    for r in rows:
        chosen = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and r[1] is not None
        other = leaf_of(r[0], r[1].translate(lower), *r[2:]) if chosen else leaf_of(*r)
        by[r[2]].append((r[0] is not None, r[0] or 0, leaf_of(*r), other, r[0]))
    sources = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: levels_of([x[2] for x in sorted(by[s])]) for s in sources}
    top = levels_of([trees[s][-1][0] for s in sources])
    out = []
    for n, s in enumerate(sources):
        for i, (_, _, leaf, other, doc) in enumerate(sorted(by[s])):
            proof, node = "", other
            for levels, at in ((trees[s], i), (top, n)):
                for level in levels[:-1]:
                    lo = at // 16 * 16
                    before, after = "".join(level[lo:at]), "".join(level[at + 1 : lo + 16])
                    proof, node, at = proof + before + after, hexed((before + node + after).encode()), at // 16
            out.append((doc, leaf, trees[s][-1][0], top[-1][0], hexed(proof.encode()), node, node == top[-1][0]))
    return out


def digests(spark, docs, folder):
    docs.write.parquet(f"{folder}/documents.parquet")
    return [tuple(r) for r in merkle.query(spark, str(folder)).collect()]


def test_layout_and_siblings():
    for levels in range(1, 5):
        places = [merkle.address(levels, d, i) for d in range(levels) for i in range(16**d)]
        assert sorted(places) == list(range(merkle.nodes_in(levels)))
    assert merkle.address(4, 2, 17) == 17 + 17 * 17  # the upper two levels, then 17 lower subtrees of two levels
    for size in (1, 2, 16, 17, 300):
        leaves = [hashlib.sha256(b"%d" % i).digest() for i in range(size)]
        levels = merkle.height_of(size) + 1
        nodes = merkle.build(leaves, levels)
        found = merkle.all_siblings(nodes, levels, size)
        assert found == [merkle.siblings(nodes, levels, size, i) for i in range(size)]
        assert all(merkle.fold(leaf, *path) == nodes[:32] for leaf, path in zip(leaves, found))


def test_merkle_hard_cases(spark, docs, rows, tmp_path):
    key = lambda r: tuple(map(str, r))
    assert sorted(digests(spark, docs, tmp_path), key=key) == sorted(plain_proofs(rows), key=key)


def test_merkle_single_row_and_nothing(spark, docs, tmp_path):
    one = docs.filter("doc_id = 3")
    row = digests(spark, one, tmp_path / "one")[0]
    assert row[1] == row[2] == row[3] == row[5] and row[4] == hexed(b"") and row[6]
    assert digests(spark, docs.filter("false"), tmp_path / "none") == []


def test_merkle_of_several_rounds(spark, tmp_path):
    """A hot source of more leaves than one subtree holds, and more sources than a run."""
    rows = [(i, f"Text {i}", "hot" if i % 3 else f"s{i % 60}", None, i) for i in range(9000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, n_chars long").repartition(5)
    assert sorted(digests(spark, docs, tmp_path)) == sorted(plain_proofs(rows))


# --- hard negatives ---


def plain_negatives(rows, anchors, k=5):
    kept = [r for r in rows if None not in r and all(v is not None and math.isfinite(v) for v in r[1])]
    dims = max((len(r[1]) for r in kept), default=0)
    whole = [([math.floor(256 * v) for v in r[1]] + [0] * dims)[:dims] for r in kept]
    out = []
    for a, x in zip(kept, whole):
        if a[0] % anchors:
            continue
        scored = [(max(-(1 << 63), min((1 << 63) - 1, sum(p * q for p, q in zip(x, y)))), r[0], r[2]) for r, y in zip(kept, whole) if r[0] != a[0]]
        scored.sort(key=lambda s: (-s[0], s[1]))
        for p in [s for s in scored if s[2] == a[2]][:k]:
            fit = [s for s in scored if s[2] != a[2] and 80 * p[0] <= 100 * s[0] <= 100 * p[0]][:k]
            out += [(a[0], p[1], n, s[1], p[0], s[0]) for n, s in enumerate(fit, 1)]
    return sorted(out)


def table(spark, rows, kind="float"):
    shape = f"vec_id long, embedding array<{kind}>, label int, score string, block string"
    return spark.createDataFrame([(*r, "x", "y") for r in rows], shape).repartition(3)


def mined(spark, rows, anchors, kind="float"):
    return sorted(tuple(r) for r in hard_negatives.mine(table(spark, rows, kind), F.col("vec_id") % anchors == 0).collect())


def clustered(n, dims=8, groups=6, spread=0.05, seed=3):
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(groups, dims))
    x = (centres[np.arange(n) % groups] + draw.normal(size=(n, dims)) * spread).astype(np.float32)
    return [(i, [float(v) for v in row], int(draw.integers(0, 3))) for i, row in enumerate(x)]


def test_hard_negatives(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "BLOCK", 50)
    rows = clustered(400)
    rows += [(1000 + i, rows[5][1], i % 3) for i in range(60)]  # copies: ties, blocks that end among them
    rows += [(2000, None, 1), (2010, [1.0, None], 1), (2020, [float("nan")] * 8, 1), (2030, [float("inf")] * 8, 1), (2040, rows[1][1], None)]
    rows += [(2050, [0.0] * 8, 0), (2060, [], 1), (2070, [0.5, -0.25], 2), (None, rows[0][1], 1)]
    want = plain_negatives(rows, 10)
    assert len(want) > 500 and mined(spark, rows, 10) == want


def test_hard_negatives_of_huge_components(spark):
    draw = random.Random(2)
    rows = [(i, [draw.uniform(-1, 1) * 10 ** draw.choice([0, 6, 9, 15]) for _ in range(3)], i % 2) for i in range(60)]
    assert mined(spark, rows, 4, "double") == plain_negatives(rows, 4)


def test_hard_negatives_of_few_rows(spark):
    assert mined(spark, [], 10) == []
    assert mined(spark, [(0, [1.0], 1)], 10) == []
    assert mined(spark, [(0, [1.0], 1), (1, [1.0], 1), (2, [0.9], 0)], 10) == [(0, 1, 1, 2, 65536, 58880)]
    assert mined(spark, [(0, [-1.0], 1), (1, [1.0], 1), (2, [0.9], 0)], 10) == []  # a negative score has an empty window


def test_bounds_hold_and_prune(spark):
    """On vectors in clusters most pairs are settled by their bounds alone."""
    rows = clustered(3000, dims=16, groups=30)
    x = np.floor(256 * np.array([r[1] for r in rows]))
    norms, angles = hard_negatives.describe(x, hard_negatives.directions_of(x[:200], hard_negatives.REFERENCES))
    low, high = hard_negatives.score_bounds(norms[:50], angles[:50], norms, angles)
    scores = x[:50] @ x.T
    assert (low <= scores).all() and (scores <= high).all()
    best = np.sort(scores, axis=1)[:, -5:][:, :1]
    assert (high >= best).mean() < 0.25


def test_visits_are_pruned_by_blocks(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "BLOCK", 100)
    rows = table(spark, clustered(3000, dims=16, groups=30))
    blocks = hard_negatives.index(rows, F.col("vec_id") % 100 == 0)
    home = blocks.mapInArrow(hard_negatives._at_home(5), hard_negatives._ANCHOR.replace("anchor long", "anchor string", 1) + ", found array<struct<id: long, score: long>>")
    least, greatest = hard_negatives.block_bounds()
    fits = greatest >= F.coalesce(F.element_at("found", -1)["score"].cast("double"), F.lit(-1e18))
    visits = hard_negatives._visits(home, blocks, fits, 8, 1).count()
    assert visits < 0.4 * blocks.count() * 30


# --- near duplicates: long sets, near misses, clashing names ---


def test_ngram_join_of_long_and_nearly_similar_texts(spark):
    """Groups of long near copies, some just similar enough and some just not."""
    draw, docs = random.Random(11), []
    for group, (n, changes) in enumerate([(3000, 40), (3000, 130), (400, 8), (400, 16), (60, 1), (60, 3)]):
        base = [f"g{group}w{draw.randrange(10**6)}" for _ in range(n)]
        for _ in range(7):
            words = list(base)
            for at in draw.sample(range(n), changes):
                words[at] = f"x{draw.randrange(10**9)}"
            docs.append((len(docs), " ".join(words)))
    want = brute.jaccard_components(docs)
    table = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    found = ngram_join.join(table, 4, 85).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, found)) == sorted((d, *v) for d, v in want.items())
    assert 6 < len({v[1] for v in want.values()}) < len(docs)


def test_fine_parities_bound_the_difference():
    draw = np.random.default_rng(5)
    for n in (3, 700, 5000):
        a = draw.integers(0, 1 << 60, n).astype(np.uint64)
        b = np.concatenate([a[n // 7 :], draw.integers(0, 1 << 60, n // 5).astype(np.uint64)])
        x, y = (ngram_join._fine_parities(s).view(np.uint64) for s in (a, b))
        size = min(len(x), len(y))
        x, y = (v if len(v) == size else v[:size] ^ v[size:] for v in (x, y))
        apart = int(np.unpackbits((x ^ y).view(np.uint8)).sum())
        real = len(np.setxor1d(a, b))
        assert real / 2 < apart <= real or n == 3


def test_clashing_columns(spark):
    names = ["_row_key", "_doc_id", "_kept_key", "_kept_id", "_bad_key", "_bad_id", "row_key", "item_id", "node", "label"]
    shape = "doc_id long, text string, " + ", ".join(f"{n} string" for n in names)
    text = "one two three four five six seven eight nine ten eleven twelve"
    docs = spark.createDataFrame([(i, t, *names) for i, t in enumerate([text, text, "quite another text", None])], shape)
    kept = ngram_join.survivors(docs, 5, 80)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [0, 2, 3]
    items = spark.createDataFrame([("i", text)], "item_id string, text string")
    clean = decontam.decontaminate(docs, items)
    assert clean.columns == docs.columns and [tuple(r)[2:] for r in clean.collect()] == [tuple(names)] * 2


def test_stage_keeps_columns_that_the_model_names_too(spark):
    import corpus_pipeline

    words = ["the house is big and the dog is here", "la casa es grande y el perro no esta"]
    rows = [(i, (words[i % 2] + " ") * (2 + i % 3), "en" if i % 2 == 0 else "es", "own", "mine", "yes") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score string, lang_pred string, accepted string")
    kept = corpus_pipeline.known_language(spark, docs, "")
    assert kept.columns == docs.columns and {tuple(r)[3:] for r in kept.collect()} == {("own", "mine", "yes")}


# --- long texts ---


def test_many_addresses_in_one_text(spark):
    parts = [f"u{i}@m{i % 7}.org" if i % 3 else "10.0.0.1" if i % 2 else "+49 (0) 30 123456" for i in range(20000)]
    text = "\u00fc " + " , ".join(parts) + " call 555-123-4567"
    table = spark.createDataFrame([(1, text), (2, "u@m.org"), (3, None)], "doc_id long, text string")
    began = time.monotonic()
    found = {r["doc_id"]: r for r in pii.find(table).collect()}
    assert time.monotonic() - began < 60  # minutes, when positions were summed anew for every match
    for doc, t in ((1, text), (2, "u@m.org"), (3, "")):
        base = brute.private_spans(t)
        got = [(s["kind"], s["start"], s["end"]) for s in found[doc]["base"]]
        assert got == [tuple(b[:3]) for b in base]
    assert all(0 <= s["start"] < s["end"] <= len(text) for s in found[1]["spans"])


def test_context_ahead_of_a_span_is_the_text_s(spark):
    texts = ["tel +49 30 1234567", "x" * 100 + " phone: " + "+1 2 a " * 30 + "+49 30 1234567", "+1 2" * 12 + " +49 30 1234567", "\u00fc" * 50 + "+49 30 1234567"]
    for text in texts:
        cut = pii._cut(F.col("text"), "phone", pii.BASE["phone"], True)
        seen = spark.createDataFrame([(text,)], "text string").select(F.explode(pii._voted(cut, "phone", True)).alias("s")).select("s.*").collect()
        assert seen
        for s in seen:
            ahead = text[max(0, s["start"] - pii.BEFORE) : s["start"]].lower()
            said = 1 if re.search(pii.CUES["phone"], ahead) else -1 if re.search(pii.AGAINST, ahead) else 0
            assert s["votes"][2] == said and text[s["start"]] == "+"


def test_document_equal_to_a_long_item(spark):
    words = [f"w{i * 7919 % 15000}" for i in range(20000)]
    texts = [" ".join(words), "x y z " + " ".join(words[500:9000]) + " end", "a " * 20000, "some other words"]
    items = [("i1", " ".join(words)), ("i2", "a " * 500), ("i3", "other words")]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    table = spark.createDataFrame(items, "item_id string, text string")
    began = time.monotonic()
    got = {r["doc_id"]: (r["n_words"], r["n_hit"], r["item_ids"]) for r in decontam.marked(docs, table).collect()}
    assert time.monotonic() - began < 60  # did not end when every place carried its text
    assert got == {0: (20000, 20000, ["i1"]), 1: (8504, 8500, ["i1"]), 2: (20000, 20000, ["i2"]), 3: (3, 2, ["i3"])}


def _clusters(rng, groups, each, dims):
    centres = rng.normal(size=(groups, dims)) * 4
    return np.concatenate([c + rng.normal(size=(each, dims)) * 0.1 for c in centres])


def test_topk_prunes_clusters():
    """On clustered vectors, most pairs of leaves and most visits of single queries are ruled out, and no true partner is."""
    points = np.floor(_clusters(np.random.default_rng(2), 40, 50, 16) * 1024)
    tree = topk.Tree(points)
    leaf, distance = tree.leaf_of(points)
    leaves = len(tree.levels[-1])
    radius = np.full(leaves, -1.0)
    np.maximum.at(radius, leaf, distance)
    scores = points @ points.T
    np.fill_diagonal(scores, -np.inf)
    kth = np.sort(scores, axis=1)[:, -10]
    worst = np.full(leaves, np.inf)
    np.minimum.at(worst, leaf, kth)
    alive = topk.surviving(tree, radius, radius, worst)
    used = (radius >= 0).sum()
    visits = topk.reach(tree, points, leaf, kth, alive, radius)
    partners = scores >= kth[:, None]
    assert visits[np.nonzero(partners)[0], leaf[np.nonzero(partners)[1]]].all()
    assert alive.sum() < 0.25 * used**2
    assert visits.sum() < 0.15 * len(points) * used


def test_topk_query_groups():
    tree = topk.Tree(np.random.default_rng(3).normal(size=(500, 3)))
    sizes = np.random.default_rng(4).integers(0, 40, len(tree.levels[-1]))
    sizes[7] = 230
    first, parts = topk.query_groups(tree, sizes, 100)
    held = defaultdict(float)
    for f, p, n in zip(first, parts, sizes):
        for g in range(f, f + p):
            held[g] += n / p
    assert max(held.values()) <= 100 and parts[7] == 3 and sum(held.values()) == pytest.approx(sizes.sum())
    assert len(held) < sizes.sum() / 30


def test_topk_rows_of_one_id_and_large_components(spark):
    rows = [(0, [1.0, 2.0]), (0, [3.0, -1.0]), (0, [1.0, 2.0]), (1, [5.0, 5.0]), (2, [5.0, 5.0]), (2, [6.0, 4.0]), (3, [1e30, 0.0]), (4, [-1e30, 0.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = [tuple(r) for r in topk.search(table, F.col("vec_id") == 0, 10).orderBy("rank").collect()]
    top, low = (1 << 63) - 1, -(1 << 63)
    one = 1024 * 1024
    assert found == [(0, 1, 3, top), (0, 2, 1, 15 * one), (0, 3, 2, 15 * one), (0, 4, 2, 14 * one), (0, 5, 4, low)]


def test_topk_many_leaves(spark):
    """A sample as large as the tree takes, several levels, against brute force."""
    rng = np.random.default_rng(6)
    points = rng.normal(size=(3000, 4)).round(3)
    table = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)], "vec_id long, embedding array<double>")
    whole = np.floor(points * 1024)
    found = defaultdict(list)
    for r in topk.search(table, F.col("vec_id") % 100 == 0, 10).collect():
        found[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    assert len(found) == 30
    for q, got in found.items():
        scores = (whole @ whole[q]).astype(int)
        want = sorted((-s, i) for i, s in enumerate(scores.tolist()) if i != q)[:10]
        assert sorted(got) == [(n + 1, i, -s) for n, (s, i) in enumerate(want)]


@pytest.mark.parametrize("ids", [[5], [3, 3, 3], [-4, 1 << 62, (1 << 63) - 1, -(1 << 63), -4], list(range(1000, 0, -3))])
def test_suffix_ids_round_trip(ids):
    ids = np.array(ids, np.int64)
    assert suffix_dedup._unpack_ids(suffix_dedup._pack_ids(ids), len(ids)).tolist() == ids.tolist()


def test_suffix_ids_follow_keys_not_buckets():
    """Ids sent per key stay under a few bytes, however many buckets there are: no row carries those of its whole block."""
    rng = np.random.default_rng(8)
    passage = rng.integers(97, 123, 300, dtype=np.uint8).tobytes()
    texts = [rng.integers(97, 123, 500, dtype=np.uint8).tobytes() + passage for _ in range(2000)]
    block = suffix_dedup.Block(list(range(7, 7 + 3 * len(texts), 3)), [len(t) for t in texts], b"".join(texts), 50)
    places = np.arange(0, block.size - 50, 3)
    sent = {}
    for buckets in (32, 320, 3200):
        keys = suffix_dedup.Keys(block.keys(places, 50), block.owner(places), block.ids, buckets, suffix_dedup.SUFFIX_BITS, suffix_dedup.CHECK_BITS)
        rows = list(suffix_dedup._suffix_questions(keys))
        sent[buckets] = sum(len(r[3]) for r in rows) / len(keys.code)
        assert sum(len(r[2]) for r in rows) == 4 * len(keys.code)
    assert max(sent.values()) < 4  # a table of the block's ids in every row would be 8 * 2000 * 3200 bytes: 96 a key


def test_strings_of_one_code_are_told_apart():
    codes, checks = np.array([5, 7, 5, 5, 7], np.uint64), np.array([1, 2, 9, 1, 2], np.uint32)
    order, first = suffix_dedup._by_string(codes, checks, None)
    assert sorted(map(sorted, (g.tolist() for g in np.split(order, np.flatnonzero(first)[1:])))) == [[0, 3], [1, 4], [2]]
    assert suffix_dedup._by_string(codes[:0], checks[:0], checks[:0])[1].tolist() == []


def test_frequency_bound_hardly_rises():
    """A token of 2,000 is frequent in a corpus a hundred times as large as well."""
    rng = np.random.default_rng(9)
    for level in (10, 1000, 10_000):
        sketch = rng.poisson(level, ngram_join.SKETCH)
        sketch[:5] += 2000
        classes = ngram_join.frequency_class(sketch)
        assert (classes[:5] > 0).all() and (classes[5:] == 0).all()


def test_near_copies_below_the_threshold(spark):
    """A group of near copies on both sides of the threshold, against brute force."""
    rng = random.Random(11)
    base = [f"w{i}" for i in range(120)]
    texts = []
    for i in range(90):
        words = list(base)
        for at in rng.sample(range(120), rng.randint(1, 5)):
            words[at] = f"v{i}x{at}"
        texts.append(" ".join(words))
    rows = list(enumerate(texts))
    want = brute.jaccard_components(rows, 4, 85)
    found = ngram_join.join(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), 4, 85)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found.collect()}
    assert got == {d: tuple(want[d]) for d, _ in rows}
    assert 1 < len({c for _, c in got.values()}) < 90
