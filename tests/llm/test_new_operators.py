"""Filter audit, SentencePiece pieces and hard negatives against plain versions."""

import random
import time
from itertools import permutations

import brute
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from bronzeflow.llm import filter_audit, hard_negatives, pieces, queries

FILE = queries.tokenizer_file("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=FILE)


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.load(FILE)


def test_pieces_of_all_documents_equal_the_library(spark, sf_dir, library):
    want = sorted((r["doc_id"], library.encode(r["text"] or "") + [2]) for r in brute.table(sf_dir, "documents"))
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = pieces.decode_pieces(pieces.encode_pieces(docs, FILE, 2), FILE).collect()
    assert sorted((r.doc_id, r.ids) for r in rows) == want
    assert {r.doc_id: r.decoded for r in rows} == {i: library.decode(ids) for i, ids in want}
    digests = queries.op12_pieces(spark, sf_dir).collect()
    told = {i: (len(ids), brute.sha(" ".join(map(str, ids))), brute.sha(library.decode(ids))) for i, ids in want}
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in digests} == told


@pytest.mark.parametrize(
    "text",
    ["", " ", "  ", " " * 700, "a" * 5000, "th" * 3000, "▁a ▁▁ b", "\x00\x1c\t\r\n", "日本語①ﬁ😀é", "ing" * 40 + " thethe", "<s> </s> <0x41>", "x  y   z    "],
)
def test_pieces_of_odd_texts_equal_the_library(text, vocabulary, library):
    ids = pieces.encode([text], vocabulary)[0]
    assert ids.tolist() == library.encode(text)
    assert pieces.decode(ids, vocabulary) == library.decode(ids.tolist())


def test_random_texts_in_one_block(vocabulary, library):
    rng = random.Random(3)
    texts = ["".join(rng.choice(" abcdetho\n▁é語<0>\U0001f600") for _ in range(rng.randrange(60))) for _ in range(400)]
    assert [x.tolist() for x in pieces.encode(texts, vocabulary)] == [library.encode(t) for t in texts]


def test_a_long_text_is_cut_between_words(vocabulary, library, monkeypatch):
    text = " ".join(f"word{i % 37} thing{'  ' * (i % 3)}" for i in range(900))
    want = library.encode(text)
    monkeypatch.setattr(pieces, "CHUNK", 100)
    assert pieces.encode(["", text, "b"], vocabulary)[1].tolist() == want


def test_decoding_any_ids_equals_the_library(vocabulary, library):
    rng = random.Random(5)
    for _ in range(400):
        ids = [rng.choice([0, 1, 2, rng.randrange(3, 259), rng.randrange(32000), 260]) for _ in range(rng.randrange(12))]
        assert pieces.decode(np.array(ids, dtype=np.int32), vocabulary) == library.decode(ids), ids


def one_by_one(word, ranks):
    """Merge the best pair, of equals the leftmost, until none is left."""
    parts = list(word)
    while True:
        found = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
        if not found:
            return parts
        _, i = min(found)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]


def test_rounds_equal_single_merges_for_any_ranks():
    rng = random.Random(7)
    for _ in range(150):
        names = {"a", "b", "c"} | {"".join(rng.choice("abc") for _ in range(rng.randint(2, 5))) for _ in range(rng.randint(1, 25))}
        order = sorted(names)
        rng.shuffle(order)
        scored = [(p, -float(rng.choice([i, i // 3]))) for i, p in enumerate(order)]
        held = pieces.vocabulary(scored, list(range(len(scored))), list(range(len(scored), len(scored) + 256)), len(scored) + 256)
        levels = {s: i for i, s in enumerate(sorted({s for _, s in scored}, reverse=True))}
        ranks = {p: levels[s] for p, s in scored}
        words = ["".join(rng.choice("abcab") for _ in range(rng.randint(1, 30))) for _ in range(20)]
        symbols = np.concatenate([held.symbol_of[[ord(c) for c in w]] for w in words])
        word, sym, _ = pieces.merge(symbols, np.array([len(w) for w in words]), held)
        got = [[scored[s][0] for s in sym[word == i]] for i in range(len(words))]
        assert got == [one_by_one(w, ranks) for w in words]


def test_pieces_of_odd_rows(odd_docs, no_docs, library):
    rows = pieces.decode_pieces(pieces.encode_pieces(odd_docs.withColumn("ids", F.lit(1)), FILE, 2), FILE).collect()
    assert len(rows) == odd_docs.count()
    for row in rows:
        assert row.ids == library.encode(row.text or "") + [2]
        assert row.decoded == library.decode(row.ids)
    assert pieces.decode_pieces(pieces.encode_pieces(no_docs, FILE), FILE).count() == 0


def failures_of(rows, limits=filter_audit.Limits()):
    """(part, mask, id) of (doc_id, text, source) rows."""
    first = {}
    for doc_id, text, _ in rows:
        if doc_id is not None:
            first[text or ""] = min(first.get(text or "", doc_id), doc_id)
    out = []
    for doc_id, text, source in rows:
        text = text or ""
        words = brute.words(text)
        failed = [
            len(words) < 50,
            100 * len(set(words)) < 65 * len(words),
            100 * sum("A" <= c <= "Z" for c in text) > 5 * len(text),
            any(c in "#$%&*|" for c in text),
            doc_id is not None and first[text] < doc_id,
        ]
        out.append((source or "", failed, doc_id))
    return out


def audited(rows, labels):
    labels = [x for x in labels if x[0] is not None]
    good = {i for i, q, _ in labels if q == 1}
    toxic = {i for i, _, t in labels if t == 1}
    marked, out = failures_of(rows), {}
    for part in {p for p, _, _ in marked}:
        own = [(f, i) for p, f, i in marked if p == part]
        totals = [0] * 5
        steps = {}
        for order in permutations(range(5)):
            left = own
            for step, f in enumerate(order, 1):
                gone = [x for x in left if x[0][f]]
                left = [x for x in left if not x[0][f]]
                totals[f] += len(gone)
                failing = [x for x in own if x[0][f]]
                name = "".join("ABCDE"[i] for i in order)
                steps[part, name, step] = f, [
                    len(left), len(gone), len(failing) - len(gone), sum(sum(x[0]) == 1 for x in failing),
                    sum(x[1] in good for x in gone), sum(x[1] in toxic for x in gone),
                ]
        out |= {k: (*v, totals[f]) for k, (f, v) in steps.items()}
    return out


def told(df):
    return {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley) for r in df.collect()}


def test_audit_of_odd_rows(spark, odd_docs, no_docs):
    labels = [(1, 1, 0), (2, 1, 1), (2, 0, 0), (4, None, 1), (None, 1, 1), (77, 1, 1)]
    frame = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    rows = [(r.doc_id, r.text, r.source) for r in odd_docs.collect()]
    found = told(filter_audit.audit(odd_docs, frame))
    assert found == audited(rows, labels)
    assert len(found) == 600 * len({s for _, _, s in rows})
    assert filter_audit.audit(no_docs, frame).count() == 0


def test_every_state_of_the_walk_counts_the_survivors():
    counts = np.random.default_rng(2).integers(0, 9, (32, 3, 3))
    states = filter_audit.walk(counts)
    for active in range(32):
        assert (states[active] == counts[[m for m in range(32) if not m & active]].sum(axis=0)).all()


def test_scores_from_planes_are_inner_products():
    rng = np.random.default_rng(4)
    for size, top in ((1, 3), (13, 300), (64, 256), (9, 1 << 40)):
        candidates, anchors = rng.integers(-top, top + 1, (20, size)), rng.integers(-top, top + 1, (7, size))
        shape = hard_negatives.Shape(size, int(top).bit_length() + 1, top + 1)
        tables = hard_negatives.subset_sums(anchors, shape)
        found = hard_negatives.scores(hard_negatives.bit_planes(candidates, shape), tables, shape)
        with np.errstate(over="ignore"):
            assert (found == candidates @ anchors.T).all()


def mined(rows, mining=hard_negatives.Mining()):
    """Plain version over (id, label, vector, anchor) rows."""
    top = 1 << 70
    out = []
    for a in {(r[0], r[1], tuple(r[2])) for r in rows if r[3] and r[0] is not None}:
        score = lambda v: sum(x * y for x, y in zip(a[2], v))
        others = sorted((-score(r[2]), top if r[0] is None else r[0], r[1]) for r in rows if r[0] != a[0])
        for s, i, _ in [o for o in others if o[2] == a[1]][: mining.positives]:
            fits = [o for o in others if o[2] != a[1] and mining.least_percent * -s <= 100 * -o[0] <= mining.most_percent * -s]
            name = lambda x: None if x == top else x
            out += [(a[0], name(i), rank, name(n), -s, -t) for rank, (t, n, _) in enumerate(fits[: mining.negatives], 1)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("mining", [hard_negatives.Mining(), hard_negatives.Mining(2, 4, 10, 100, table_bytes=9000, rows_per_task=10, tile=(3, 7))])
def test_negatives_of_random_rows(spark, mining):
    rng = random.Random(9)
    rows = []
    for i in range(120):
        vector = [rng.randint(-3, 6) for _ in range(rng.choice([10, 10, 9]))]
        rows.append((None if i % 37 == 5 else i // 2 if i % 11 == 0 else i, rng.randint(0, 3), vector, i % 6 == 0))
    rows += [rows[12], rows[12], (200, 1, [0] * 10, True), (201, 1, [], True)]
    frame = spark.createDataFrame(rows, "id bigint, label int, vector array<bigint>, chosen boolean").repartition(4)
    found = hard_negatives.mine(frame.withColumn("score", F.lit(1)), F.col("chosen"), mining)
    assert sorted(map(tuple, found.collect()), key=repr) == mined(rows, mining)


@pytest.mark.parametrize(("top", "real"), [(1 << 9, np.float32), (1 << 20, np.float64), (1 << 28, None)])
def test_negatives_of_large_components_are_exact(spark, top, real):
    rng = random.Random(top)
    rows = [(i, i % 3, [rng.randint(top // 2, top) for _ in range(rng.choice([9, 10]))], i % 5 == 0) for i in range(100)]
    # scores that differ by one, which floats of half the bits would not tell apart
    rows += [(200 + i, i % 3, [top] * 9 + [i], i < 3) for i in range(12)]
    assert hard_negatives.Shape(10, top.bit_length() + 1, top + 1).real is real
    frame = spark.createDataFrame(rows, "id bigint, label int, vector array<bigint>, chosen boolean").repartition(3)
    for mining in (hard_negatives.Mining(most_percent=100), hard_negatives.Mining(3, 2, table_bytes=9000, rows_per_task=10, tile=(4, 9))):
        assert sorted(map(tuple, hard_negatives.mine(frame, F.col("chosen"), mining).collect()), key=repr) == mined(rows, mining)


def test_many_anchors_are_mined_in_time(spark):
    rng, count = np.random.default_rng(6), 20_000
    vectors, labels = rng.integers(-99, 100, (count, 16)), rng.integers(0, 4, count)
    rows = pa.table([np.arange(count), labels, pa.array(vectors.tolist()), np.arange(count) % 5 < 2], names=["id", "label", "vector", "chosen"])
    start = time.perf_counter()
    found = hard_negatives.mine(spark.createDataFrame(rows), F.col("chosen")).filter("anchor_id % 2000 = 0").collect()
    assert time.perf_counter() - start < 90
    scores, want = vectors @ vectors[::2000].T, []
    for column, anchor in enumerate(range(0, count, 2000)):
        order = np.lexsort((np.arange(count), -scores[:, column]))
        best = [i for i in order[: count // 2].tolist() if i != anchor]
        for positive in [i for i in best if labels[i] == labels[anchor]][:5]:
            s = int(scores[positive, column])
            fits = [i for i in best if labels[i] != labels[anchor] and 50 * s <= 100 * scores[i, column] <= 95 * s][:3]
            want += [(anchor, positive, rank, i, s, int(scores[i, column])) for rank, i in enumerate(fits, 1)]
    assert sorted(map(tuple, found)) == sorted(want)


def test_a_small_table_is_mined_by_as_many_tasks_as_it_has_rows_for(spark, monkeypatch):
    seen = []
    mapped = hard_negatives._mapped
    monkeypatch.setattr(hard_negatives, "_mapped", lambda df, *more: seen.append(df.rdd.getNumPartitions()) or mapped(df, *more))
    frame = spark.range(1000).selectExpr("id", "id % 2 AS label", "array(id % 7, id % 5) AS vector").coalesce(1)
    hard_negatives.mine(frame, F.col("id") == 0, hard_negatives.Mining(rows_per_task=200))
    hard_negatives.mine(frame, F.col("id") == 0, hard_negatives.Mining(rows_per_task=1))
    assert seen == [5, 5] + [4 * spark.sparkContext.defaultParallelism] * 2


def test_negatives_of_tables_without_anchors(spark):
    schema = "id bigint, label int, vector array<bigint>"
    for rows in ([], [(1, 1, [1, 2])], [(0, None, [1]), (0, 1, None)]):
        assert hard_negatives.mine(spark.createDataFrame(rows, schema), F.col("id") == 0).count() == 0


def test_only_finite_vectors_take_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, -0.001]), (1, None), (2, [nan, 1.0]), (3, [1.0, None]), (4, [inf, 0.0]), (5, [-inf]), (6, [])]
    frame = spark.createDataFrame(rows, "id int, v array<float>").filter(hard_negatives.all_finite(F.col("v")))
    assert frame.select("id", hard_negatives.quantized(F.col("v")).alias("q")).collect() == [(0, [256, -1]), (6, [])]
