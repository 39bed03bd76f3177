import hashlib
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
from conftest import SF_DIR
from pyspark.sql import functions as F

import corpus_pipeline
from gleanery.llm import kneser_ney, packing, page_text, personal_data, piece_codec, quality_cascade, shingle_join, top_k, toxicity, url_trees
from gleanery.llm.queries import ORACLES, QUERIES

PIECES, WORDS = public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("word_bpe_49k.json")
LONG = " ".join(f"word{i % 977}x{i}" for i in range(30_000))
TEXTS = [None, "", " \n\t", "one two", "one two", "Call me, you idiot! " * 3, "x" * 20_000, LONG, "a\x00b　c ▁ <|endoftext|> é́ <s>", "the cat sat on the mat and saw the dog"]


@pytest.fixture(scope="module")
def documents(spark):
    """Nulls, empty and long texts, repeated rows, a null id, and columns that clash with what operators return."""
    rows = [(i if i != 3 else None, t, "en", "s", 7, "old", 0.5, 3) for i, t in enumerate(TEXTS)]
    rows.append(rows[-1])
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, digest string, score double, n long")


@pytest.fixture(scope="module")
def sf(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


def words(text):
    return (text or "").encode().lower().split()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "embeddings", "pages", "labels", "benchmark"):
        duck.sql(f"CREATE VIEW {table} AS FROM '{SF_DIR}/{table}.parquet'")
    df = QUERIES[name](spark, SF_DIR)
    result = duck.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == sorted(df.columns)
    assert Counter(tuple(r) for r in df.select(*names).collect()) == Counter(result.fetchall())


def test_top_k_cases(spark):
    rows = [(0, [1.0, 2.0], 1), (50, [1.0, 2.0], 1), (1, [1.0, 2.0], 1), (1, [1.0, 2.0], 1), (2, None, 1), (3, [1.0, None], 1), (4, [1.0, float("nan")], 1), (100, [1.0, 2.0, 3.0], 1), (None, [1.0, 2.0], 1), (5, [], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score long")
    got = [tuple(r) for r in top_k.exact_top_k(df, F.col("vec_id") % 50 == 0, 5).orderBy("query_id", "rank").collect()]
    score = 256 * 256 + 512 * 512
    assert got == [(0, 1, 1, score), (0, 2, 1, score), (0, 3, 50, score), (50, 1, 0, score), (50, 2, 1, score), (50, 3, 1, score)]
    assert top_k.exact_top_k(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_bounds_hold():
    rng = np.random.default_rng(0)
    x = rng.integers(-90, 90, (60, 37))
    for segments in (1, 2, 8, 64):
        f = top_k.segment_features(x.astype(float), segments)
        assert (f @ f.T >= x @ x.T - 1e-6).all()


def test_urls(spark):
    urls = [None, "", "no scheme", "HTTP://A.COM", "http://www.Example.com/en/x?q#f", "http://example.com/en/", "http://m.example.com/de/1", "https://a.net/es/p", "https://a.net/es", "http://x.org/casino/win-1?a=1&b=2", "http://x.org/casino/win-1?a=1&b=2"]
    df = spark.createDataFrame([(i, u, "old") for i, u in enumerate(urls)], "page_id long, url string, host string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_trees.judge(df).collect()}
    assert [got[i][:3] for i in range(4)] == [("", "", None), ("", "", None), ("", "", None), ("a.com", "", None)]
    assert got[4] == ("www.example.com", "/en/x", "www.example.com/en/", "allow")
    assert got[5] == ("example.com", "/en/", "example.com/en/", "block")
    assert got[6][2:] == ("com/", "allow") and got[7][2:] == ("net/es/", "block") and got[8][2] is None
    assert all(v[3] in ("allow", "block") for v in got.values()) and len(got) == len(urls)
    assert url_trees.judge(df.limit(0)).count() == 0


def test_trees_learn(spark):
    rows = [(f"http://h{i}.org/{'1' * (i % 2 * 9)}x", f"h{i}.org", f"/{'1' * (i % 2 * 9)}x", i % 2) for i in range(200)]
    model = url_trees.fit(spark.createDataFrame(rows, "url string, host string, path string, label int"))
    df = spark.createDataFrame(rows, "url string, host string, path string, label int")
    columns = url_trees.features(F.col("url"), F.col("host"), F.col("path"), url_trees.rate_of(F.col("host"), model))
    right = df.where((url_trees.log_odds(columns, model) >= 0) == (F.col("label") == 1)).count()
    assert right == 200


def test_copies_of_a_url_leave_room_for_others(spark):
    one = [(f"http://h{i}.org/{'1' * (i % 2 * 9)}x", f"h{i}.org", f"/{'1' * (i % 2 * 9)}x", i % 2) for i in range(40)]
    df = spark.createDataFrame([r for r in one for _ in range(60)], "url string, host string, path string, label int")
    model = url_trees.fit(df, sample_rows=40)
    assert any(model.splits)
    columns = url_trees.features(F.col("url"), F.col("host"), F.col("path"), url_trees.rate_of(F.col("host"), model))
    assert df.where((url_trees.log_odds(columns, model) >= 0) == (F.col("label") == 1)).count() == len(one) * 60


def test_quality(documents, sf):
    rows = quality_cascade.judge(documents).collect()
    assert len(rows) == len(TEXTS) + 1 and quality_cascade.judge(documents.limit(0)).count() == 0
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[0]["n_words"] == 0 and not by_id[0]["kept"] and by_id[5]["n_repeat_words"] == 12 and by_id[7]["kept"]
    kept = quality_cascade.cascade(sf).where("rejected_by is null").count()
    assert kept == quality_cascade.judge(sf).where("kept").count()


def test_toxicity(spark, documents, sf):
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    rows = toxicity.judge(documents, spark.createDataFrame([(4, 1), (None, 1), (9, None)], "doc_id long, toxic int")).collect()
    assert len(rows) == len(TEXTS) + 1 and all(0 <= r["score"] <= 1 for r in rows)
    assert toxicity.judge(documents.limit(0), labels).count() == 0
    big = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    big_labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    judged = toxicity.judge(big, big_labels).join(big_labels, "doc_id").where("held_out")
    counts = {(r["toxic"], r["predicted"]): r["count"] for r in judged.groupBy("toxic", "predicted").count().collect()}
    assert counts.get((0, 1), 0) <= 0.01 * counts[0, 0] and counts[1, 1] >= 0.8 * (counts[1, 1] + counts.get((1, 0), 0))


def test_counterfactuals_level_identity_terms():
    sample = [(1, 1, ["muslim", "vile"])] * 20 + [(0, 1, ["christian", "kind"])] * 20 + [(0, 1, ["other"])] * 20
    place = {w: i for i, w in enumerate(sorted({w for s in sample for w in s[2]} | {t for g in toxicity.IDENTITY for t in g}))}
    weights, _ = toxicity._weights(sample, place)
    assert weights[place["vile"]] > 4 * abs(weights[place["muslim"]])


def test_pages(spark):
    site = "<nav>menu</nav><div class='share-bar'>share</div><div><p>same on every page</p></div><article><h1>T {0} &amp; x</h1><p>body&nbsp; {0}<br>two<p>three {0}</article><section id=comments><article>no</article></section><footer>f</footer>"
    rows = [(i, f"http://a.com/{i}", site.format(i)) for i in range(12)] + [(90, None, None), (91, "http://b.com", ""), (92, "x", "<p>plain <b>te</b>xt")]
    rows += [(100 + i, "http://c.com", f"<body><div><span>tick</span> er</div><p>own {i}</p></body>") for i in range(12)]
    df = spark.createDataFrame([(*r, "old") for r in rows], "page_id long, url string, html string, text string")
    got = {r["page_id"]: r["text"] for r in page_text.extract(df).collect()}
    assert got[3] == "T 3 & x body 3 two three 3" and got[90] == got[91] == "" and got[92] == "plain text"
    assert got[105] == "own 5"
    assert page_text.extract(df.limit(0)).count() == 0


def test_copies_of_a_page_are_no_template(spark):
    article = "<nav>menu {0}</nav><article><h1>Head</h1><p>one and the same</p></article>"
    rows = [(i, "http://a.com/x", article.format("")) for i in range(30)]
    rows += [(100 + i, f"http://b.com/x?utm_source={i}", article.format(i)) for i in range(30)]
    rows += [(200 + i, f"http://b.com/{i}", f"<article><p>own {i}</p></article>") for i in range(12)]
    rows += [(300 + i, f"http://c.com/{i}", f"<body><div><p>box</p></div><p>own {i % 12}</p></body>") for i in range(36)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)
    got = {r["page_id"]: r["text"] for r in page_text.extract(df).collect()}
    assert len(got) == len(rows) and all(got[i] == "Head one and the same" for i in (*range(30), *range(100, 130)))
    assert all(got[200 + i] == f"own {i}" for i in range(12)) and all(got[300 + i] == f"own {i % 12}" for i in range(36))


def test_kneser_ney_sums_to_one_and_takes_every_case(spark, documents):
    rows = kneser_ney.score(documents, F.crc32(F.col("doc_id").cast("string")) % 5 == 1).collect()
    assert len(rows) == len(TEXTS) + 1 and all(np.isfinite(r["score"]) for r in rows)
    training = [words(r["text"]) for r in documents.where(~F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 1, F.lit(False))).collect()]
    assert {r["train_tokens"] for r in rows} == {sum(len(t) + 1 for t in training)}
    assert kneser_ney.score(documents.limit(0), F.lit(False)).count() == 0
    few = spark.createDataFrame([("a b a",), ("b b c",), (None,), ("a c",)], "text string")
    model = kneser_ney.fit(few)
    import pyarrow as pa

    score = lambda t: 10 ** model.score(pa.array([t]))[3][0]
    # After "a": the chances of every word, the end and the unknown word.
    whole = {w: score(f"a {w}") for w in ("a", "b", "c", "zzz")}
    stop = {w: score(w) for w in ("a",)}
    ends = {w: score(f"a {w}") / 1 for w in whole}
    assert all(0 < p < 1 for p in [*whole.values(), *stop.values(), *ends.values()])


@pytest.mark.parametrize("order", [2, 3, 4])
def test_kneser_ney_equals_brute_force(sf, order):
    rows = kneser_ney.score(sf, F.crc32(F.col("doc_id").cast("string")) % 5 == 1, order=order).collect()
    docs = [(r["doc_id"], words(r["text"]) + [1]) for r in sf.select("doc_id", "text").collect()]
    train = [t for i, t in docs if zlib.crc32(str(i).encode()) % 5 != 1]
    single = Counter(w for t in train for w in t)
    # Raw counts of all n-grams; 0 begins a text. Lower orders count different words before, but for n-grams that begin a text.
    raw = {n: Counter(tuple(([0] + t)[i : i + n]) for t in train for i in range(len(t) + 2 - n)) for n in range(1, order + 1)}
    counts = {order: raw[order]}
    for n in range(order - 1, 0, -1):
        before = Counter(g[1:] for g in raw[n + 1])
        counts[n] = before + Counter({g: c for g, c in raw[n].items() if g[0] == 0}) if n > 1 else before
    cuts = {n: kneser_ney.discounts(*[sum(c == i for c in counts[n].values()) for i in (1, 2, 3, 4)]) for n in counts}
    cut = lambda c, n: cuts[n][min(c, 3) - 1] if c else 0
    total, mass = Counter(), Counter()
    for n in range(1, order + 1):
        for g, c in counts[n].items():
            total[n, g[:-1]] += c
            mass[n, g[:-1]] += cut(c, n)

    def chance(gram):
        n = len(gram)
        less = chance(gram[1:]) if n > 1 else 1 / (len(single) + 1)
        all_ = total[n, gram[:-1]]
        return max(counts[n][gram] - cut(counts[n][gram], n), 0) / all_ + mass[n, gram[:-1]] / all_ * less if all_ else less

    got = {r["doc_id"]: r for r in rows}
    for i, t in docs[:60]:
        whole = [0, *t]
        expected = sum(np.log10(chance(tuple(whole[max(0, j + 1 - order) : j + 1]))) for j in range(1, len(whole)))
        assert got[i]["score"] == pytest.approx(expected, rel=1e-9) and got[i]["n_known"] == sum(w in single for w in t)


def test_personal_data(spark, documents, sf):
    assert personal_data.judge(documents).count() == len(TEXTS) + 1 and personal_data.judge(documents.limit(0)).count() == 0
    texts = ["é😀 a.b@c.de_d@e.fg 1.2.3.4.5.6.7.8 300.1.1.1", "4111 1111 1111 1111, 4111111111111112", "+1 (974) 555-3436 +12", "@@ a@b@c.d " + "9" * 30_000, None, ""]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").unionByName(sf.select((F.col("doc_id") + 1000).alias("doc_id"), "text"))
    for r in personal_data.judge(df).join(df, "doc_id").where("doc_id < 6 or doc_id % 3 = 0").collect():
        spans = base_spans(r["text"] or "")
        assert r["base_sha256"] == hashlib.sha256(",".join(spans).encode()).hexdigest(), r
        assert set(spans) <= set(r["spans"].split(","))
        assert [r[f"n_{k}"] for k in ("email", "ip", "card", "phone")] == [sum(s.startswith(k) for s in spans) for k in ("email", "ip", "card", "phone")]


def base_spans(text):
    def luhn(digits):
        values = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
        return sum(v - 9 if v > 9 else v for v in values) % 10 == 0

    patterns = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}
    out = []
    for kind, pattern in patterns.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            fine = {"email": True, "ip": kind == "ip" and all(int(p) < 256 for p in m[0].split(".")), "card": 16 <= len(digits) <= 19 and luhn(digits), "phone": 8 <= len(digits) <= 15}[kind]
            if fine:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


def test_every_form_of_an_address_part(spark):
    """Zeros, leading zeros and both sides of the bound, in each of the four places."""
    parts = ["0", "00", "000", "007", "10", "99", "100", "199", "200", "249", "250", "255", "256", "0255", "0256", "300", "1000"]
    texts = [f"ip {'.'.join([*['1'] * place, part, *['2'] * (3 - place)])} end" for part in parts for place in range(4)]
    texts += ["0.0.0.0", "127.0.0.1 10.0.0.1", "255.255.255.255", "0" * 4000 + ".0.0.1", "0" * 4000 + "999.0.0.1"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = personal_data.judge(df).collect()
    for r in rows:
        spans = base_spans(texts[r["doc_id"]])
        assert r["n_ip"] == sum(s.startswith("ip:") for s in spans), texts[r["doc_id"]]
        assert r["base_sha256"] == hashlib.sha256(",".join(spans).encode()).hexdigest()
    assert sum(r["n_ip"] for r in rows) > 40


def test_overlapping_spans_are_replaced_as_one(spark):
    """An address within a longer number, a mail whose host is an address, spans that touch."""
    texts = ["a@1.2.3.4 x", "+1 10.20.30.40 5", "1.2.3.4 5.6.7.8", "é a@b.cd;c@d.ef"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: r["text"] for r in personal_data.redact(df).collect()}
    assert found == {0: "[EMAIL] x", 1: "[PHONE]", 2: "[IP] [IP]", 3: "é [EMAIL];[EMAIL]"}


def test_redaction(spark):
    df = spark.createDataFrame([(0, "mail a@b.cd or 1.2.3.4!", 1), (1, None, 1), (2, "nothing", 1)], "doc_id long, text string, extra int")
    assert [r["text"] for r in personal_data.redact(df).orderBy("doc_id").collect()] == ["mail [EMAIL] or [IP]!", None, "nothing"]


def test_piece_codec(documents):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    rows = piece_codec.digests(documents, PIECES).collect()
    expect = Counter()
    for r in documents.collect():
        ids = [1, *library.encode(r["text"] or ""), 2]
        expect[r["doc_id"], len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest()] += 1
    assert Counter(tuple(r) for r in rows) == expect
    assert piece_codec.digests(documents.limit(0), PIECES).count() == 0


def test_packing(documents, sf):
    known = packing.tokenizer(WORDS)[0]
    both = documents.select("doc_id", "text").unionByName(sf.where("doc_id >= 10").select("doc_id", "text"))
    rows = packing.pack(both, WORDS).collect()
    by_doc = defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
    expect = defaultdict(Counter)
    for r in both.collect():
        ids = np.array([*known.encode(r["text"] or "", add_special_tokens=False).ids, 1], "<u4")
        for start in range(0, len(ids), 2048):
            piece = ids[start : start + 2048]
            expect[r["doc_id"]][start, len(piece), zlib.crc32(piece.tobytes()), len(ids)] += 1
    assert {k: Counter((r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in v) for k, v in by_doc.items()} == expect
    sequences = defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    totals = []
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
        totals.append(at)
    assert sorted(sequences) == list(range(len(sequences))) and sum(totals) > 0.97 * 2048 * len(totals)
    assert packing.pack(documents.limit(0), WORDS).count() == 0


def test_shingle_join(spark, documents):
    rows = shingle_join.grouped(documents).collect()
    assert len(rows) == len(TEXTS) + 1 and shingle_join.grouped(documents.limit(0)).count() == 0
    rng = np.random.default_rng(3)
    base = [[f"w{x}" for x in rng.integers(0, 400, n)] for n in rng.integers(1, 160, 25)]
    texts = []
    for i in range(500):
        t = list(base[i % 25])
        for _ in range(rng.integers(0, 3)):
            t[rng.integers(0, len(t))] = f"w{rng.integers(0, 400)}"
        texts.append(" ".join(t))
    equals_all_pairs(spark, texts)


@pytest.mark.parametrize("length, most", [(60, 8), (150, 12)])
def test_shingle_join_of_one_group(spark, length, most):
    """A group of near copies, many of them too far from its middle to be linked with that, but some with one another."""
    rng = np.random.default_rng(length)
    base, texts = [f"w{x}" for x in rng.integers(0, 5000, length)], []
    for _ in range(400):
        t = list(base)
        for _ in range(rng.integers(0, most)):
            at, kind = rng.integers(0, len(t)), rng.integers(0, 3)
            t[at : at + (0, 1, 4)[kind]] = [f"v{rng.integers(0, 9)}"] if kind < 2 else []
        texts.append(" ".join(t))
    equals_all_pairs(spark, texts)


def test_shingle_join_takes_rows_not_keys(spark):
    """Rows with null or repeated ids connect, and leave their groups, like any other."""
    base = [f"w{i}" for i in range(60)]
    near = [" ".join(t) for t in ([*base[:55], *"abcde"], base, [*"fghij", *base[5:]])]
    other = [" ".join(f"{c}{i}" for i in range(40)) for c in "xyz"]
    rows = [(4, near[0]), (None, near[1]), (9, near[2]), (7, other[0]), (7, other[1]), (3, other[1] + " more"), (8, other[2]), (8, other[2] + " more"), (None, other[2] + " end"), (None, ""), (5, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r["component_id"] or 0, r["doc_id"] or 0) for r in shingle_join.grouped(df).collect())
    assert got == [(0, 0), (3, 3), (3, 7), (4, 0), (4, 4), (4, 9), (5, 5), (7, 7), (8, 0), (8, 8), (8, 8)]
    kept = [(r["doc_id"], r["text"]) for r in shingle_join.first_of_groups(df).collect()]
    assert sorted(i for i, _ in kept if i is not None) == [3, 4, 5, 7, 8] and [t for i, t in kept if i is None] == [""]
    assert (7, other[0]) in kept and (7, other[1]) not in kept


def equals_all_pairs(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sets = [frozenset(zip(*[w[k:] for k in range(5)])) if len(w) >= 5 else frozenset([tuple(w)]) for w in (t.split() for t in texts)]
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in shingle_join.grouped(df).collect()}
    assert got == {i: (len(sets[i]), find(i)) for i in range(len(texts))}


def test_pipeline(spark, sf):
    docs = sf
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stage(spark, docs, SF_DIR)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == before.columns and docs.dtypes == before.dtypes
            docs = spark.createDataFrame(docs.collect(), docs.schema)
            assert 0 < docs.count() <= before.count()
    assert docs.count() >= before.count()
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, sf.limit(0), SF_DIR).count() == 0
