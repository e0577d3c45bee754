"""Operators that compare documents with each other, against brute force on small tables."""

import hashlib
import math
import pathlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from loyalscope.llm import common, embedding_join, jaccard_join, pitman_yor, queries, suffix_dedup
from loyalscope.session import shared_folder
from odd_rows import odd, nothing, documents  # noqa: F401

SMALL = "/root/testdata/sf0.001"


def classes(nodes, edges):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def fold(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def spaced(text):
    return re.findall("[^\x20\x09-\x0d]+", fold(text))


# Helpers


@pytest.mark.parametrize("edges", [[], [(1, 1)], [(i, i + 1) for i in range(30)], [(9, i) for i in range(9)], [(5, 6), (7, 8), (8, 5), (20, 3)]])
def test_components(spark, edges):
    got = {r.node: r.component for r in common.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    linked = [e for e in edges if e[0] != e[1]]
    assert got == classes({n for e in linked for n in e}, linked)


def test_components_of_random_links(spark):
    rng = random.Random(4)
    edges = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(220)]
    got = {r.node: r.component for r in common.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    linked = [e for e in edges if e[0] != e[1]]
    assert got == classes({n for e in linked for n in e}, linked)


@pytest.mark.parametrize("limit", [1, 40, 1 << 21])
def test_words_and_groups(limit):
    texts = ["Ab c", None, "", " x\ty ", "É-1 é", "last", "a" * 50 + " b"]
    data, starts = common.text_bytes(pa.array(texts))
    seen = []
    for first, last in common.groups(starts, limit):
        words = common.Words(data[starts[first] : starts[last]], starts[first : last + 1] - starts[first], common.NOT_SPACE)
        for a, b in zip(words.first, words.first[1:]):
            seen.append(words.hash[a:b].tolist())
    assert seen == [[common.word_hash(w, common.NOT_SPACE) for w in spaced(t)] for t in texts]


def test_packed_texts_come_back(odd):
    chunk = {}
    for r in common.pack(odd, 3).collect():
        chunk.setdefault(r.chunk, []).append(bytes(r.blob))
    rows = [tuple(r.values()) for blobs in chunk.values() for r in common.unpack(pa.table({"blob": blobs})).to_pylist()]
    assert sorted(rows, key=repr) == sorted([(r.doc_id, r.text) for r in odd.collect()], key=repr)


# Vectors


def brute_vectors(rows, threshold=0.93):
    good = [(i, np.array(e, float), label) for i, e, label in rows if i is not None and e and label is not None and all(x is not None and math.isfinite(x) for x in e) and any(e)]
    good = [(i, x / np.abs(x).max(), label) for i, x, label in good]
    links, edges = Counter(), []
    for k, (i, x, a) in enumerate(good):
        for j, y, b in good[k + 1 :]:
            if a == b and len(x) == len(y) and x @ y / math.sqrt((x @ x) * (y @ y)) >= threshold:
                links[i] += 1
                links[j] += 1
                edges.append((i, j))
    return links, classes([i for i, _, _ in rows if i is not None], edges)


@pytest.mark.parametrize("block,leaf", [(2048, 256), (5, 2)])
def test_vectors_match_brute_force(spark, block, leaf):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(9, 7))
    rows = [(i, (centres[i % 9] + rng.normal(size=7) * 0.25).tolist(), None if i % 23 == 0 else i % 2) for i in range(150)]
    rows += [(200 + i, [3.0, 0.0, 0.0, 0.0, 0.0, 0.0, -0.0], 1) for i in range(12)] + [(230, [1e300] * 7, 1), (231, [1e-300] * 7, 1), (232, [-5e307] * 7, 0)]
    rows += [(300, None, 1), (301, [], 1), (302, [0.0] * 7, 1), (303, [1.0, None, 1.0], 1), (304, [float("nan")] * 7, 1), (305, [float("inf")] + [0.0] * 6, 1), (306, [1.0, 2.0], 1), (307, [1.0, 2.0], 1), (None, [1.0, 2.0], 1)]
    rng.shuffle(order := list(range(len(rows))))
    frame = spark.createDataFrame([rows[k] for k in order], "vec_id long, embedding array<double>, label int").withColumn("n_links", F.lit("clash"))
    links, component = brute_vectors(rows)
    for r in embedding_join.link(frame, block=block, leaf=leaf).collect():
        if r.vec_id is None:
            assert r.n_links == 0 and r.component_id is None
        else:
            assert (r.n_links, r.component_id, r.kept) == (links[r.vec_id], component[r.vec_id], component[r.vec_id] == r.vec_id), r
    assert embedding_join.link(frame).count() == len(rows)
    assert embedding_join.link(frame.where("1 = 0")).count() == 0


def test_repeated_vectors_each_count(spark):
    frame = spark.createDataFrame([(1, [1.0, 0.0], 0)] * 3 + [(2, [1.0, 0.01], 0)], "vec_id long, embedding array<float>, label int")
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in embedding_join.link(frame).collect()) == [(1, 3, 1)] * 3 + [(2, 3, 1)]


def test_distant_intervals_are_left_out():
    a, b = np.array([[0, 0], [1, 5]]), np.array([[3, 0], [4, 1]])
    assert embedding_join.distant(a, b) and not embedding_join.distant(a, b - [[1, 0], [1, 0]])


# Jaccard


def brute_texts(docs):
    sets = {}
    for i, t in docs:
        w = spaced(t)
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    ids = [i for i in sets if i is not None]
    edges = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    return {i: len(s) for i, s in sets.items()}, classes(ids, edges)


def near_texts(seed, n=260):
    """Texts of which many are near copies, about the threshold, and many share a passage."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 6)))
    passage = [word() for _ in range(30)]
    bodies, docs = [], []
    for i in range(n):
        if bodies and rng.random() < 0.6:
            w = list(rng.choice(bodies))
            for _ in range(rng.randint(0, max(1, len(w) // 25))):
                k = rng.randrange(len(w))
                w[k : k + rng.randint(0, 2)] = [word()]
        else:
            w = [word() for _ in range(rng.choice([1, 3, 4, 5, 6, 20, 60, 150]))]
            if rng.random() < 0.5:
                w[len(w) // 2 : len(w) // 2] = passage[: rng.choice([10, 30])]
        bodies.append(w)
        docs.append((i, rng.choice([" ", "\n", "  "]).join(w)))
    return docs


@pytest.mark.parametrize("seed,spare", [(1, 10), (2, 3), (3, 1000)])
def test_classes_match_brute_force(spark, seed, spare):
    docs = near_texts(seed) + [(1000, None), (1001, ""), (1002, " \n"), (1003, "A b"), (1004, "a  B"), (1005, "b a")]
    sizes, component = brute_texts(docs)
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(5).withColumn("component_id", F.lit("clash"))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.classify(frame, spare).collect()}
    assert got == {i: (sizes[i], component[i]) for i, _ in docs}


def test_classes_when_candidates_are_not_broadcast(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BROADCAST_ROWS", 0)
    docs = near_texts(7, 80)
    sizes, component = brute_texts(docs)
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in jaccard_join.classify(frame).collect()} == component
    assert sorted(r.doc_id for r in jaccard_join.keep_one(frame).collect()) == sorted(set(component.values()))


def test_shared_entries_over_batch_borders():
    rng = random.Random(0)
    rows = sorted((rng.randint(0, 40), rng.randint(0, 6), 5) for _ in range(150))
    expected = {(h, x) for h, x, _ in rows if len({y for g, y, _ in rows if g == h}) > 1}
    for size in (1, 2, 3, 7, 200):
        batches = [pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[i : i + size]), (pa.int64(), pa.int64(), pa.int32()))], names=["h", "x", "n"]) for i in range(0, len(rows), size)]
        got = [(r["h"], r["x"]) for b in jaccard_join._shared(iter(batches)) for r in b.to_pylist()]
        assert len(got) == len(set(got)) and set(got) == expected, size


def test_similar_texts_of_odd_rows(odd, nothing):
    rows = jaccard_join.classify(odd).collect()
    assert sorted([(r.doc_id, r.component_id) for r in rows], key=repr) == sorted([(i, i) for i in (1, 2, 3, 4, 5, 6, 7, 9, None)] + [(8, 1)] * 2, key=repr)
    kept = jaccard_join.keep_one(odd)
    assert kept.columns == odd.columns and sorted([r.doc_id for r in kept.collect()], key=repr) == sorted([1, 2, 3, 4, 5, 6, 7, 9, None], key=repr)
    assert jaccard_join.classify(nothing).count() == 0 and jaccard_join.keep_one(nothing).count() == 0


def test_one_of_repeated_rows_stays(spark):
    frame = spark.createDataFrame([(1, "a b c d e f")] * 3 + [(2, "x")], "doc_id long, text string")
    assert sorted(r.doc_id for r in jaccard_join.keep_one(frame).collect()) == [1, 2]


# Suffixes


def brute_repeats(docs, window=suffix_dedup.WINDOW):
    seen, out = set(), {}
    for i, t in sorted(docs):
        raw = (t or "").encode()
        covered = bytearray(len(raw))
        for p in range(len(raw) - window + 1):
            w = raw[p : p + window]
            if w in seen:
                covered[p : p + window] = b"\1" * window
            seen.add(w)
        kept = bytes(x for x, c in zip(raw, covered) if not c)
        out[i] = (len(raw), sum(covered), sum(c and not (p and covered[p - 1]) for p, c in enumerate(covered)), hashlib.sha256(kept).hexdigest())
    return out


def repeats_of(frame, **more):
    return {r.doc_id: tuple(r)[1:5] for r in suffix_dedup.deduplicate(frame, **more).collect()}


@pytest.mark.parametrize("size", [common.CHUNK_BYTES, 1 << 12])
def test_repeats_match_brute_force(spark, monkeypatch, size):
    monkeypatch.setattr(suffix_dedup, "chunk_count", lambda docs: common.chunk_count(docs, size))
    rng = random.Random(size)
    text = lambda n, of="abé \n": "".join(rng.choice(of) for _ in range(n))
    parts = [text(rng.choice([60, 99, 100, 101, 150, 400])) for _ in range(12)]
    docs = [(i, "".join(rng.choice([text(rng.randint(0, 80)), rng.choice(parts)]) for _ in range(rng.randint(0, 6)))) for i in range(80)]
    docs += [(100, None), (101, ""), (102, "a" * 500), (103, "ab" * 300), (104, "a" * 99), (105, "\0" * 150), (106, "\0" * 149 + "a")]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(4).withColumn("chunk", F.lit("clash"))
    assert repeats_of(frame) == brute_repeats(docs)


def test_repeats_in_given_documents(spark, documents):
    assert repeats_of(documents) == brute_repeats([(r.doc_id, r.text) for r in documents.collect()])


def test_repeats_of_odd_rows(odd, nothing):
    rows = suffix_dedup.deduplicate(odd, with_text=True).collect()
    by_id = {r.doc_id: r for r in rows}
    assert len(rows) == odd.count() and by_id[2].n_bytes == 0 and by_id[2].clean_text is None
    assert by_id[9].n_removed == 150_000 - 5 and by_id[9].n_spans == 1 and by_id[9].clean_text == "word "
    assert suffix_dedup.deduplicate(nothing).count() == 0


def test_loser_tree_sorts_and_knows_prefixes():
    rng = random.Random(9)
    runs = [sorted("".join(rng.choice("ab") for _ in range(rng.randint(1, 12))).encode() for _ in range(rng.randint(0, 30))) for _ in range(7)]
    merged = [(k, n) for _, _, k, n in suffix_dedup.LoserTree([suffix_dedup.front_coded(r) for r in runs])]
    keys = [k for k, _ in merged]
    assert keys == sorted(k for r in runs for k in r)
    for (a, _), (b, n) in zip(merged, merged[1:]):
        assert n == suffix_dedup.common_prefix(a, b, 0)


def test_merging_never_looks_at_known_prefixes(monkeypatch):
    looked = []
    plain = suffix_dedup.common_prefix
    runs = [suffix_dedup.front_coded(sorted(b"x" * 500 + bytes([65 + k, c]) for c in range(40))) for k in range(4)]
    monkeypatch.setattr(suffix_dedup, "common_prefix", lambda a, b, known: looked.append(known) or plain(a, b, known))
    assert len(list(suffix_dedup.LoserTree(runs))) == 160
    assert sum(k < 500 for k in looked) <= 3  # the first round of matches alone


# Language model


def brute_base(docs):
    token = lambda t: [("w", w) for w in spaced(t)] + ["end"]
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2
    counts = Counter(w for i, t in docs if not held(i) for w in token(t))
    n, v = sum(counts.values()), len(counts)
    return {i: (held(i), len(token(t)), sum(counts[w] > 0 for w in token(t)), n, sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in token(t))) for i, t in docs}


@pytest.mark.parametrize("size", [pitman_yor.CHUNK_BYTES, 1 << 16])
def test_counts_and_base_match_brute_force(spark, documents, size):
    docs = [(r.doc_id, r.text) for r in documents.collect()] + [(-1, None), (-2, ""), (-3, "word " * 2000)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumn("score", F.lit("clash"))
    expected = brute_base(docs)
    rows = pitman_yor.score(frame, size).collect()
    assert len(rows) == len(docs)
    for r in rows:
        assert tuple(r)[1:5] == expected[r.doc_id][:4] and r.base_score == pytest.approx(expected[r.doc_id][4], rel=1e-9)
        assert r.score < 0


def test_model_predicts_held_out_text_better_than_the_base(spark):
    rows = queries.op5_pitman_yor(spark, "/root/testdata/sf0.01").where("held_out").agg(F.sum("score"), F.sum("base_score"), F.sum("n_tokens")).first()
    assert rows[0] / rows[2] > rows[1] / rows[2] + 0.1


def test_probabilities_of_all_words_add_up_to_one():
    rng = np.random.default_rng(0)
    words, contexts = 60, 6
    pairs = [(c, w) for w in range(words) for c in range(contexts) if rng.random() < 0.4 or c == 0]
    context, word = np.array([c for c, _ in pairs]), np.array([w for _, w in pairs])
    count = rng.integers(1, 200, len(pairs)) * (rng.random(len(pairs)) < 0.3) + 1
    s = pitman_yor.seat(context, word, count, 1, 3)
    assert (s["t"] >= 1).all() and (s["t"] <= count).all() and (s["mid_t"] >= 1).all() and (s["mid_t"] <= s["mid_c"]).all()
    leaf = (np.bincount(context, count, contexts), np.bincount(context, s["t"], contexts))
    parent = (np.bincount(s["mid_restaurant"], s["mid_c"], contexts // 2), np.bincount(s["mid_restaurant"], s["mid_t"], contexts // 2))
    totals = pitman_yor.Totals(leaf, parent, s["root"].sum(), words, int(count.sum()))
    for c in range(contexts):
        own, up, root = np.zeros(words + 1), np.zeros(words + 1), np.zeros(words + 1)
        here = context == c
        own[word[here]] = count[here] - pitman_yor.DISCOUNT[0] * s["t"][here]
        below = context // 2 == c // 2
        up[word[below]] = (s["mid_c"] - pitman_yor.DISCOUNT[1] * s["mid_t"])[s["mid"][below]]
        root[:words] = s["root"] - pitman_yor.DISCOUNT[2]
        assert totals.probability(np.full(words + 1, c), own, up, root).sum() == pytest.approx(1)


def test_chance_of_sitting_alone_matches_seating():
    rng = np.random.default_rng(1)
    discount, strength, met, alone = 0.5, 1.0, Counter(), Counter()
    for _ in range(20_000):
        sizes = []
        for n in range(6):
            p = np.array([s - discount for s in sizes] + [strength + discount * len(sizes)]) / (n + strength)
            k = rng.choice(len(p), p=p / p.sum())
            sizes[k : k + 1] = [sizes[k] + 1] if k < len(sizes) else [1]
        met[len(sizes)] += 6
        alone[len(sizes)] += sizes.count(1)
    chance = pitman_yor._alone(discount)
    for t in (2, 3, 4):
        assert chance[6, t] == pytest.approx(alone[t] / met[t], abs=0.02)
    assert chance[1, 1] == 1 and chance[6, 1] == 0 and chance[6, 6] == 1


def test_scores_of_odd_rows(spark, odd, nothing):
    rows = {r.doc_id: r for r in pitman_yor.score(odd).collect()}
    assert rows[2].n_tokens == rows[3].n_tokens == rows[4].n_tokens == 1 and rows[9].n_tokens == 30_001 and rows[None].n_tokens == 17
    assert pitman_yor.score(odd).count() == odd.count() and pitman_yor.score(nothing).count() == 0
    held = next(i for i in range(100) if pitman_yor.held_out(i))
    lone = pitman_yor.score(spark.createDataFrame([(held, "nothing to learn from")], "doc_id long, text string")).first()
    assert lone.train_tokens == 0 and lone.n_known == 0 and lone.score == lone.base_score == 0


def test_rare_words_are_contexts(spark):
    """Each of 400 words foretells the next one; none is a two-hundredth of the tokens."""
    rng = random.Random(8)
    texts = [" ".join(f"left{k} right{k}" for k in rng.sample(range(400), 30)) for _ in range(200)]
    rows = pitman_yor.score(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).where("held_out")
    r = rows.agg(F.sum("score").alias("score"), F.sum("base_score").alias("base"), F.sum("n_tokens").alias("n")).first()
    # about half the tokens follow from the word before, so they cost little more than nothing
    assert r.score / r.n > 0.65 * r.base / r.n


@pytest.mark.parametrize("customers", [50, 100_000])
def test_tables_do_not_depend_on_where_they_start(monkeypatch, customers):
    monkeypatch.setattr(pitman_yor, "BURN_IN", 10)  # what other dishes made of the start fades over some sweeps
    rng = np.random.default_rng(5)
    words = np.arange(3000)
    context, word = np.repeat([0, 1, 2], 3000), np.tile(words, 3)
    count = np.maximum(1, (20_000 / (words + 3) * rng.exponential(1, (3, 3000))).astype(int)).ravel()
    count[0] = customers
    mean = []
    for start in (1, customers):
        first = np.ones(len(count), dtype=np.int64)
        first[0] = start
        mean.append(np.mean([pitman_yor.seat(context, word, count, first, seed)["t"][0] for seed in range(12)]))
    assert max(mean) < 1.5 * min(mean)


@pytest.mark.parametrize("c, others, customers, tables, rest, total", [(60, 100, 5, 1, 1e-3, 1000), (1000, 5000, 50, 10, 0.5, 1e4), (3000, 50_000, 100, 20, 1.0, 1e5), (9000, 10, 0, 0, 0.01, 100)])
def test_drawn_tables_match_their_distribution(c, others, customers, tables, rest, total):
    most, n, i = 2000, 3000, np.arange(2000)
    taken = pitman_yor.DISCOUNT[1] * max(tables, 1)
    log = pitman_yor._stirling(pitman_yor.DISCOUNT[0], c, most)[c, 1 : most + 1]
    log = log + np.log((pitman_yor.STRENGTH[0] + pitman_yor.DISCOUNT[0] * (others + i)) * (np.maximum(customers + i - taken, 0) + rest) / (pitman_yor.STRENGTH[1] + total + i)).cumsum()
    p = np.exp(log - log.max()) / np.exp(log - log.max()).sum()
    mean = (p * (i + 1)).sum()
    all_ = lambda x: np.full(n, float(x))
    t = pitman_yor.draw(np.random.default_rng(1), np.full(n, c), all_(others), 0, all_(customers), all_(tables), all_(rest), all_(total))
    assert t.mean() == pytest.approx(mean, rel=0.03) and t.std() == pytest.approx(np.sqrt((p * (i + 1 - mean) ** 2).sum()), rel=0.1, abs=0.05)


def test_scores_do_not_depend_on_the_number_of_parts(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    one, many = ({(r.doc_id, r.n_tokens): r.score for r in pitman_yor.score(docs, size).collect()} for size in (pitman_yor.CHUNK_BYTES, 1 << 15))
    assert one.keys() == many.keys() and sum(many.values()) == pytest.approx(sum(one.values()), rel=0.005)
    assert all(many[k] == pytest.approx(one[k], rel=0.03) for k in one)


def test_a_hot_word_is_scored_alike_by_any_number_of_parts(spark):
    rng = random.Random(3)
    texts = [" ".join(f"the w{min(int(rng.paretovariate(0.8)), 3000)}" for _ in range(40)) for _ in range(300)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    one, many = (pitman_yor.score(docs, size).agg(F.sum("score")).first()[0] for size in (pitman_yor.CHUNK_BYTES, 1 << 13))
    assert many == pytest.approx(one, rel=0.003)


def test_scores_leave_little_on_disk(spark):
    """Neither shuffle files nor tables that no later step reads stay; words are named once a chunk, not in every bundle."""
    def taken():
        env = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
        return sum(p.stat().st_size for top in [shared_folder(spark).removeprefix("file:"), *(d.getPath() for d in env.localDirs())] for p in pathlib.Path(top).rglob("*") if p.is_file() and (p.suffix == ".parquet" or p.name.startswith("shuffle_")))

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    size, before = docs.agg(F.sum(F.octet_length("text"))).first()[0], taken()
    rows = pitman_yor.score(docs, size // 6)  # every step but the last
    assert taken() - before < 1.2 * size
    assert rows.count() == docs.count()


@pytest.mark.parametrize("n", [50, 3 << 20])
def test_trigrams_survive_bundles(n):
    rng = np.random.default_rng(n)
    given = [np.minimum(rng.pareto(0.5, 3000).astype(np.int64), n - 1) for _ in range(3)]
    v, x, w, number = pitman_yor.trigrams(*given, n, n)
    assert all((a[number] == b).all() for a, b in zip((v, x, w), given))
    assert sorted(set(zip(*given))) == list(zip(v.tolist(), x.tolist(), w.tolist()))
    several = [pitman_yor._opened(pitman_yor._bundle(**pitman_yor._folded(v[a:b], x[a:b], w[a:b]))) for a, b in ((0, 1), (1, 700), (700, len(v)))]
    *back, parent, leaf = pitman_yor._unfolded(several)
    assert all((a == b).all() for a, b in zip(back, (v, x, w)))
    assert set(np.flatnonzero(parent)) >= set(np.flatnonzero(np.diff(v, prepend=-1))) and (leaf | ~parent).all()
    odd = {"a": np.array([-5, 1 << 40]), "b": np.zeros(0), "c": np.array([0.25, -3]), "d": np.array([True, False])}
    again = pitman_yor._opened(pitman_yor._bundle(**odd))
    assert all((again[k] == odd[k]).all() and len(again[k]) == len(odd[k]) for k in odd)


def test_rows_of_two_texts_under_one_id_are_told_apart(spark):
    a, b = "one two three four five six seven", "all other words that stand in the second text"
    rows = [(5, a, "x"), (3, a, "y"), (5, b, "z"), (9, b, "w"), (5, None, "n"), (5, " ", "s"), (None, a, "i"), (7, b, "v"), (7, b, "u")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, set_key string")
    kept = sorted(((r.doc_id, r.text) for r in jaccard_join.keep_one(frame).collect()), key=repr)
    assert kept == sorted([(3, a), (5, b), (5, None), (5, " "), (None, a)], key=repr)
