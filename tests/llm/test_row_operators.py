"""Operators that answer row by row, against brute force on small tables."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from loyalscope.llm import decontamination, language_id, license_scan, pii, queries, sentencepiece_codec, sharding
from odd_rows import odd, nothing, documents  # noqa: F401

SMALL = "/root/testdata/sf0.001"


# Licences


def test_license_digest_ignores_case_punctuation_and_holders(spark):
    body = license_scan.LICENSES[0][1]
    docs = spark.createDataFrame([
        (1, body), (2, body.upper().replace("2020 Someone", "1999, 2003 Another One")), (3, body + " But not for Fridays."),
        (4, None), (5, ""), (6, "Copyright 2020 Me"), (7, "released under the mit licence"), (7, "released under the mit licence"),
        (None, "Licensed under CC BY-NC 4.0!"),
    ], "doc_id long, text string").withColumn("license_id", F.lit("clash"))
    rows = [(r.doc_id, r.license_id, r.is_license) for r in license_scan.scan(docs).collect()]
    assert sorted(rows, key=repr) == sorted([
        (1, "MIT", True), (2, "MIT", True), (3, None, False), (4, None, False), (5, None, False), (6, None, False),
        (7, "MIT", True), (7, "MIT", True), (None, "CC-BY-NC-4.0", True)], key=repr)
    assert license_scan.scan(docs.where("1 = 0")).count() == 0


def test_wrapped_licenses_keep_their_digest(spark):
    import textwrap

    rows = []
    for license_id, body in license_scan.LICENSES:
        for width in (30, 40, 55, 61, 72, 79, 100):
            wrapped = "\n\n".join(textwrap.fill(p, width, break_long_words=False, break_on_hyphens=False) for p in body.split("\n\n"))
            rows.append((len(rows), license_id, wrapped))
    isc = license_scan.LICENSES[2][1].replace("the above copyright notice", "the above\ncopyright notice")
    rows += [(len(rows), "ISC", isc), (len(rows) + 1, "MIT", "MIT License\nCopyright 1999 Someone\nCopyright (C) 2001 Another\n\n" + license_scan.LICENSES[1][1]),
             (len(rows) + 2, "MIT", "Copyright Someone Else\n\n" + license_scan.LICENSES[1][1])]
    got = {r.doc_id: r.license_id for r in license_scan.scan(spark.createDataFrame([(i, t) for i, _, t in rows], "doc_id long, text string")).collect()}
    assert [(i, got[i]) for i, want, _ in rows if got[i] != want] == []


def test_whole_licenses_are_found_at_any_width(spark):
    import re
    import textwrap

    rows = []
    for license_id, text in license_scan.shipped():
        paragraphs = re.split(r"\n[ \t]*\n", text)
        for width in (None, 50, 72, 100):  # notices keep lines of their own
            rewrap = lambda p: p if width is None or re.search(r"(?im)^\W*(copyright|all rights)", p) else textwrap.fill(p, width, break_long_words=False, break_on_hyphens=False)  # noqa: E731,B023
            rows.append((len(rows), license_id, "\n\n".join(map(rewrap, paragraphs))))
    got = {r.doc_id: r.license_id for r in license_scan.scan(spark.createDataFrame([(i, t) for i, _, t in rows], "doc_id long, text string")).collect()}
    assert len(rows) == 36 and [(i, want, got[i]) for i, want, _ in rows if got[i] != want] == []


# Sharding


def test_shards_of_odd_rows(odd, nothing):
    tree = sharding.even_tree(5)
    rows = sharding.shard_documents(odd, tree, sharding.grown(tree, 5)).collect()
    assert len(rows) == odd.count()
    by_id = {r.doc_id: r for r in rows}
    assert by_id[2].size == 16 and by_id[2].text_crc32 == 0
    assert by_id[6].text_crc32 == zlib.crc32("É ß 日本語 𝒳 ' \" ; -- %".encode()) and by_id[6].size == len("É ß 日本語 𝒳 ' \" ; -- %".encode()) + 16
    for shard in {r.shard for r in rows}:
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(sum(r.shard == shard for r in rows)))
    assert sharding.shard_documents(nothing, tree).count() == 0


def test_growth_moves_rows_into_the_new_shard_only(spark):
    keys = spark.range(40_000).withColumn("text", F.lit("x")).withColumnRenamed("id", "doc_id")
    tree = sharding.even_tree(40)
    rows = sharding.shard_documents(keys, tree, sharding.grown(tree, 40)).toPandas()
    assert set(rows.grown_shard[rows.shard != rows.grown_shard]) == {40}
    assert 0.6 < (rows.shard != rows.grown_shard).mean() * 41 < 1.4
    counts = rows.groupby("shard").size()
    assert len(counts) == 40 and counts.min() > 800 and counts.max() < 1200


def test_heavier_shard_moves_rows_within_its_subtrees_only(spark):
    keys = spark.range(20_000).select("id")
    leaves = [sharding.leaf(s) for s in range(8)]
    light = sharding.inner("root", [sharding.inner("a", [sharding.inner("r", leaves[:4])]), sharding.inner("b", [sharding.inner("s", leaves[4:])])])
    heavy = sharding.inner("root", [sharding.inner("a", [sharding.inner("r", [sharding.leaf(0, 2.0), *leaves[1:4]])]), sharding.inner("b", [sharding.inner("s", leaves[4:])])])
    rows = keys.select(sharding.place(F.col("id"), light).alias("x"), sharding.place(F.col("id"), heavy).alias("y")).toPandas()
    moved = rows[rows.x != rows.y]
    assert set(moved.y) <= {0, 1, 2, 3}  # never into the unchanged subtree
    assert set(moved[moved.x < 4].y) == {0}  # within the changed one into the heavier shard alone


# Language


def test_language_of_held_out_documents(spark):
    rows = queries.op7_language_id(spark, "/root/testdata/sf0.01").join(
        spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang"), "doc_id").where("held_out").toPandas()
    right = (rows.lang_pred == rows.lang)
    assert right.mean() > 0.95
    assert rows.accepted[right].mean() > 0.98
    assert rows.score.between(0, 1).all()


def test_language_of_odd_rows(odd, nothing, documents):
    model = language_id.train(documents, sample=200)
    rows = language_id.identify(odd, model)
    assert [c for c in odd.columns if c != "score"] + ["lang_pred", "score", "accepted"] == rows.columns
    got = [(r.doc_id, r.lang_pred, r.accepted) for r in rows.collect()]
    assert len(got) == odd.count()
    assert {(i, a) for i, p, a in got if p == "und"} == {(2, False), (3, False), (4, False)}
    assert language_id.identify(nothing, model).count() == 0
    nobody = language_id.train(documents.where("1 = 0"))
    assert {r.lang_pred for r in language_id.identify(odd, nobody).collect()} == {"und"}


def test_language_is_learned_from_text_alone(documents):
    a = language_id.train(documents, sample=100)
    b = language_id.train(documents.withColumn("source", F.lit("other")), sample=100)
    assert np.array_equal(a.vectors, b.vectors) and a.threshold == b.threshold


# Decontamination


def brute_hits(text, items, window=13):
    pattern = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
    fold = lambda s: pattern.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in s or ""))
    words, hit, found = fold(text), set(), set()
    for item, body in items:
        run = fold(body)
        k = min(window, len(run))
        grams = {tuple(run[i : i + k]) for i in range(len(run) - k + 1)} if k else set()
        for i in range(len(words) - k + 1):
            if tuple(words[i : i + k]) in grams:
                hit |= set(range(i, i + k))
                found.add(item)
    return len(words), len(hit), sorted(found)


@pytest.mark.parametrize("size", [decontamination.BLOCK_BYTES, 60])
def test_hits_match_brute_force(spark, size):
    rng = random.Random(3)
    text = lambda n: " ".join(rng.choice("ab cd ef É7 x".split()) for _ in range(n))
    items = [(i, text(rng.choice([0, 1, 3, 6, 14, 20]))) for i in range(12)] + [(90, ""), (91, None), (92, "É7; AB\ncd!")]
    items.append((93, items[5][1]))
    docs = [(i, text(rng.randint(0, 120))) for i in range(40)] + [(100 + i, f"{text(5)}, {b} {text(4)}") for i, b in items if b] + [(200, None), (201, ""), (202, items[4][1])]
    bench = spark.createDataFrame([*items, (None, "ab ab ab")], "item_id long, text string")
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumn("hit_items", F.lit("clash"))
    rows = decontamination.match(frame, bench, size=size).collect()
    got = {r.doc_id: (r.n_words, sum(s.end - s.begin for s in r.hit_spans), sorted(r.hit_items)) for r in rows}
    assert got == {i: brute_hits(t, items) for i, t in docs}


def test_windows_with_long_items(spark):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(6)]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, text(40)) for i in range(6)]
    docs = [(i, text(10) + " " + " ".join(items[i % 6][1].split()[i % 9 : i % 9 + 10 + i % 7]) + " " + text(12)) for i in range(60)]
    rows = decontamination.judge(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {r.doc_id: (r.n_words, r.n_hit, sorted(r.hit_items)) for r in rows} == {i: brute_hits(t, items) for i, t in docs}


def test_decontamination_of_odd_rows(spark, odd, nothing):
    bench = spark.createDataFrame([(1, "fox jumps over the LAZY dog")], "item_id long, text string")
    rows = {r.doc_id: r for r in decontamination.judge(odd, bench).collect()}
    assert rows[1].n_hit == 6 and rows[1].contaminated and rows[2].n_words == 0 and not rows[2].contaminated
    assert rows[9].n_words == 30_000
    assert decontamination.judge(nothing, bench).count() == 0
    assert not any(r.contaminated for r in decontamination.judge(odd, bench.where("1 = 0")).collect())
    cut = {r.doc_id: r for r in decontamination.remove_spans(odd, bench).collect()}
    assert cut[1].text == "The quick brown   and runs away from the big bad wolf today" and list(cut[1].asDict()) == odd.columns


# Personal data


def naive_base(text):
    spans = []
    for kind in pii.KINDS:
        for m in pii.STRICT[kind].finditer(text):
            digits = [c for c in m.group() if c.isdigit()]
            ok = True
            if kind == "ip":
                ok = all(int(p) <= 255 for p in m.group().split("."))
            if kind == "phone":
                ok = 10 <= len(digits) <= 15
            if kind == "card":
                doubled = [sum(divmod(int(c) * 2, 10)) if i % 2 else int(c) for i, c in enumerate(reversed(digits))]
                ok = 14 <= len(digits) <= 19 and sum(doubled) % 10 == 0
            if ok:
                spans.append((m.start(), kind, m.end()))
    return ",".join(f"{k}:{a}:{b}" for a, k, b in sorted(spans, key=lambda s: (s[0], pii.KINDS.index(s[1]), s[2])))


def test_strict_spans_match_the_plain_patterns():
    rng = random.Random(2)
    pieces = ["a", "@", ".", "b-", "+1", " ", "(", ")", "5", "255", "4111111111111111", "-", "10.0.0.1", "é", "x@y.z", "+49 30 1234567", "\n", "0" * 9]
    for _ in range(20_000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randint(0, 14)))
        assert pii.listed(pii.strict_spans(text)) == naive_base(text), text


def test_personal_data_of_odd_rows(odd, nothing, documents):
    detector = pii.train(documents)
    rows = {r.doc_id: r for r in pii.find(odd, detector).collect()}
    assert (rows[7].n_email, rows[7].n_ip, rows[7].n_card, rows[7].n_phone) == (1, 1, 1, 1)
    assert rows[2].spans == "" and rows[9].spans == ""
    assert pii.find(nothing, detector).count() == 0
    clean = {r.doc_id: r.text for r in pii.redact(odd, detector).collect()}
    assert clean[7] == "Mail <EMAIL> or 10.0.0.256 and <IP>, card <CARD>, <PHONE>" and clean[2] is None and clean[1] == rows[1].text


def test_base_of_the_query(spark):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    for r in queries.op9_pii(spark, SMALL).collect():
        base = naive_base(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(base.encode()).hexdigest()
        assert not base or set(base.split(",")) <= set(r.spans.split(","))


def test_trees_learn_a_rule():
    from loyalscope.llm import boosting

    rng = np.random.default_rng(0)
    x = rng.integers(0, 10, (2000, 4)).astype(float)
    y = ((x[:, 0] > 4) ^ (x[:, 2] > 6)).astype(float)
    model = boosting.fit(x[:1500], y[:1500])
    assert ((model.probability(x[1500:]) > 0.5) == y[1500:]).mean() > 0.98


# Pieces


@pytest.fixture(scope="module")
def library():
    sentencepiece = pytest.importorskip("sentencepiece")
    return sentencepiece.SentencePieceProcessor(model_proto=queries.piece_model())


@pytest.fixture(scope="module")
def codec():
    return sentencepiece_codec.Codec(queries.piece_model())


def test_ids_equal_the_library_on_random_texts(library, codec):
    rng = random.Random(1)
    for _ in range(3000):
        text = "".join(rng.choice("aaabeht  ▁\n\t\x00éß日𝒳<s>/12.,-'ing the") for _ in range(rng.randint(0, 60)))
        ids = library.encode(text)
        assert codec.encode(text) == ids and codec.decode(ids) == library.decode(ids), text
    for n in range(100):
        for text in (" " * n, "a" + " " * n + "b", "e" * n):
            assert codec.encode(text) == library.encode(text)


def test_pieces_of_the_query(spark, library):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    rows = queries.op10_sentencepiece(spark, SMALL).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = library.encode(texts[r.doc_id])
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_pieces_of_odd_rows(odd, nothing, library):
    model = queries.piece_model()
    rows = sentencepiece_codec.decode(sentencepiece_codec.encode(odd, model), model).collect()
    assert len(rows) == odd.count()
    for r in rows:
        assert r.token_ids == library.encode(r.text or "") and r.decoded == library.decode(r.token_ids)
    assert sentencepiece_codec.digests(nothing, model).count() == 0
    empty = {r.doc_id: r for r in sentencepiece_codec.digests(odd, model).collect()}
    assert empty[2].n_tokens == 0 and empty[2].ids_sha256 == empty[3].ids_sha256 == hashlib.sha256(b"").hexdigest()


def test_planted_loose_spans_are_added_and_clean_texts_stay_clean(spark):
    rng = __import__("random").Random(11)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(3, 8)))

    def card():
        start = "4" + "".join(rng.choice("0123456789") for _ in range(14))
        return next(start + d for d in "0123456789" if pii.luhn(start + d))

    def text(i):
        middle = (f"{word()}{i}@{word()}.example.com", card(), f"+1 ({rng.randint(201, 989)}) 555-{rng.randint(1000, 9999)}", f"{rng.randint(0, 10**16):016d}", f"{rng.randint(1, 9)}.{rng.randint(10, 99)}", f"{rng.randint(1990, 2030)}-{rng.randint(10, 12)}-{rng.randint(10, 28)}")[i % 6]
        return " ".join([*(word() for _ in range(8)), middle, *(word() for _ in range(8))])

    detector = pii.train(spark.createDataFrame([(i, text(i)) for i in range(1800)], "doc_id long, text string"))
    number = card()
    spaced = ".".join(number[i : i + 4] for i in (0, 4, 8, 12))
    for kind, span in (("email", "jane.roe (at) mail (dot) example (dot) com"), ("card", spaced), ("phone", "1 (743) 555-3824")):
        full = f"abc dfe {span} hij abd"
        assert detector.spans(full) == [(8, 8 + len(span), kind)]
    for clean in ("abc 7.25 dfe", "abd 2021-11-12 hij", "abc 9182736455463728 gha", "meet (at) noon", "the year 1999.2000", spaced[:-1] + str((int(spaced[-1]) + 1) % 10)):
        assert detector.spans(clean) == pii.strict_spans(clean)


def test_pairs_stay_apart_just_if_merging_leaves_them(codec):
    rng = random.Random(12)
    whole = [p for p in codec.halves if codec.merged(p) == [p]] + sorted(codec.chars)
    short = [p for p in whole if len(p) <= 3]
    alike = [p for p in whole if len(set(p)) <= 2]
    pairs = [(rng.choice(some), rng.choice(some)) for some in (whole, short, alike) for _ in range(8000)]
    pairs += [(p[:k], p[k:]) for p in rng.sample(whole, 3000) for k in range(1, len(p)) if {p[:k], p[k:]} <= codec.score.keys()]
    pairs = [(a, b) for a, b in pairs if codec.merged(a) == [a] and codec.merged(b) == [b]]
    assert codec.ranked and [(a, b) for a, b in pairs if codec.apart(a, b) != (codec.merged(a + b) == [a, b])] == []


def test_one_unit_of_a_million_letters_and_forgotten_words(codec, library, monkeypatch):
    rng = random.Random(13)
    for unit in ("".join(rng.choice("abcdehilnorst") for _ in range(1_000_000)), "a" * 200_000, "é" * 50_000, " " * 100_000):
        ids = codec.encode(unit)
        assert ids == library.encode(unit) and codec.decode(ids) == library.decode(ids)
    monkeypatch.setattr(sentencepiece_codec, "REMEMBERED", 7)
    monkeypatch.setattr(sentencepiece_codec, "PAIRS", 5)
    text = " ".join("".join(rng.choice("abcdeé") for _ in range(rng.randrange(1, 9))) for _ in range(3000))
    assert codec.encode(text) == library.encode(text)


def test_long_words_take_no_longer_than_other_text():
    import time

    spoken = "write to some one (at) host (dot) org. " * 3
    for word in ("x" * 1_000_000 + "@", "x@" * 200_000, "1" * 1_000_000, "1." * 300_000, "+1" * 300_000, "a(at)" * 200_000, "4 " * 300_000, "%" * 1_000_000 + " (at) b"):
        start = time.process_time()
        for kind in pii.KINDS:
            pii.proposals(spoken + word, kind)
        pii.strict_spans(spoken + word)
        assert time.process_time() - start < 30, word[:5]  # quadratic search would take hours


def test_looser_addresses_are_those_of_the_pattern():
    rng = random.Random(9)
    pieces = ["a", "b.c", "@", " ", "(at)", "[at]", " (at) ", "(dot)", " [dot] ", ".", "(", "]", "\n", "é", "-", ",", "9"]
    for _ in range(6000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randint(0, 14)))
        assert [m.span() for m in pii._loose_matches(text, "email")] == [m.span() for m in pii.LOOSE["email"].finditer(text)], text
        assert [m.span() for m in pii._matches(text.replace("a", "1").replace("b", "22"), "ip")] == [m.span() for m in pii.STRICT["ip"].finditer(text.replace("a", "1").replace("b", "22"))]


def test_all_documents_give_examples_and_the_same_trees_near_and_far(spark, monkeypatch):
    from loyalscope.llm import boosting

    texts = [f"call 00{i:04d}-555-{i % 977:04d} or +1 555 {i:07d}, write to a{i} (at) b.c or a{i}@b.example.org" for i in range(4000)] + ["a (at) b", None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    every = [kind for t in texts for kind, _, _ in pii.examples(t or "")]
    counted = {r.kind: r.n for r in pii.candidates(docs).groupBy("kind").agg(F.sum("n").alias("n")).collect()}
    assert counted == {kind: every.count(kind) for kind in set(every)}
    seen = []
    grown = boosting.grown
    monkeypatch.setattr(boosting, "grown", lambda start, *rest, **named: seen.append(start) or grown(start, *rest, **{**named, "trees": 3}))
    near = pii.train(docs)
    monkeypatch.setattr(pii, "FEW", 0)
    assert pii.train(docs) == near
    assert sum(n for n, _ in seen[0].values()) > 0.6 * len(every)


def test_cuts_are_the_quantiles_of_all_rows(spark):
    rng = np.random.default_rng(5)
    for size, top in ((1, 3), (20, 4), (33, 1000), (2000, 300), (500, 2)):
        x = rng.integers(0, top, (size, len(pii.FEATURES)))
        rows = spark.createDataFrame([("card", bytearray(r.astype("<i4").tobytes()), 1, 0) for r in x], "kind string, x binary, n long, good long")
        for f, cut in enumerate(pii._cuts(rows)["card"]):
            assert cut.tolist() == np.unique(np.quantile(x[:, f], np.linspace(0, 1, 33)[:-1], method="lower")).tolist()


def test_a_worker_holds_the_words_of_little_text_at_once(codec, monkeypatch):
    import tracemalloc

    import pyarrow as pa
    from loyalscope.llm.common import groups, text_bytes

    monkeypatch.setattr(codec, "young", {})
    monkeypatch.setattr(codec, "old", {})
    rng = __import__("random").Random(4)
    texts = [" ".join("".join(rng.choices("abcdefghijklmnop", k=6)) for _ in range(15_000)) for _ in range(40)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(40), pa.int64()), pa.array(texts)], names=["doc_id", "text"])
    tracemalloc.start()
    try:
        for first, last in groups(text_bytes(batch.column("text"))[1], sentencepiece_codec.TEXT_BYTES):
            sentencepiece_codec._digested(codec, batch.slice(first, last - first), sentencepiece_codec.OUT)
        assert tracemalloc.get_traced_memory()[1] < 250 << 20
    finally:
        tracemalloc.stop()
