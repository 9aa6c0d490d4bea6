"""Quality, toxicity, language, SimHash, page differencing and neighbours against brute force."""

import itertools
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from vitalflow.llm import ann, components, langid, line_quality, near_dup, page_diff, queries, simhash, toxicity

DOCS = "doc_id long, text string, lang string, source string, n_chars long, kept string, score string, root string, `row` string, fp string"


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and very long texts, repeated rows, names that clash with results."""
    queries.prepare(spark)
    x = ("x",) * 5
    rows = [
        (1, None, "en", None, 0, *x), (2, "", None, "s", 0, *x), (3, " \n\t\n ", "en", "s", 0, *x),
        (4, "the same words here again", "en", "s", 1, *x), (4, "the same words here again", "en", "s", 1, *x),
        (None, "the other words are here", "en", "s", 1, *x), (6, "wort und satz " * 40_000, "de", "s", 1, *x),
        (7, "12 34 !!", "en", "s", 1, *x), (8, "\x00 odd ퟿ é́ 日本", "fr", "s", 1, *x),
    ]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def tables(spark, sf_dir):
    queries.prepare(spark)
    return {n: spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in ("documents", "labels", "pages", "embeddings")}


# --- quality ------------------------------------------------------------------
def brute_base(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {i + k for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for k in range(5)}
    return [len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)]


def test_base_measures(tables):
    rng = random.Random(4)
    texts = [None, "", "a b c d e", "a a a a a a", "a b c d e a b c d e", "x\nx\n\nx \n y"]
    texts += ["".join(rng.choice("ab \n|&") for _ in range(rng.randint(0, 80))) for _ in range(1500)]
    texts += [r[0] for r in tables["documents"].select("text").limit(80).collect()]
    for text in texts:
        assert line_quality.describe(text)[0] == brute_base(text), text


def test_viterbi_finds_the_best_sequence():
    rng = np.random.default_rng(1)
    for _ in range(300):
        n = int(rng.integers(1, 8))
        field = line_quality.Field(np.zeros((1, 2)), rng.normal(size=(2, 2)), rng.normal(size=2))
        scores = rng.normal(size=(n, 2))

        def value(path):
            steps = sum(field.steps[a, b] for a, b in zip(path, path[1:]))
            return field.start[path[0]] + steps + sum(scores[i, y] for i, y in enumerate(path))

        best = max(map(value, itertools.product((0, 1), repeat=n)))
        assert value(field.decode(scores)) == pytest.approx(best)


def test_field_tells_content_from_boilerplate(spark, tables):
    docs, labels = tables["documents"], tables["labels"]
    field = line_quality.train(docs, labels)
    rows = line_quality.judge(docs, field).join(labels, F.col("row.doc_id") == labels["doc_id"]).collect()
    good = [r["kept"] for r in rows if r["quality"] == 1 and not r["base_failed"]]
    poor = [r["kept"] for r in rows if r["quality"] == 0]
    assert np.mean(good) > 0.97 and np.mean(poor) < 0.1


def test_quality_of_odd_input(odd, tables):
    got = line_quality.judge(odd, None)
    assert got.select("row.*").columns == odd.columns
    rows = got.collect()
    assert len(rows) == odd.count()
    assert all(r["base_failed"] and not r["kept"] for r in rows if not (r["row"]["text"] or "").strip())
    assert line_quality.judge(odd.limit(0), None).count() == 0
    assert line_quality.train(odd, tables["labels"].limit(0)) is None


# --- language -------------------------------------------------------------------
def brute_grams(text):
    words = "".join(c if c.isalpha() else " " for c in (text or "").lower()).split()
    out = Counter()
    for word in words:
        padded = f"\x01{word}\x01"
        out.update(word)
        out.update(padded[i : i + 2] for i in range(len(padded) - 1))
        out.update(padded[i : i + 3] for i in range(len(padded) - 2))
    return out


@pytest.mark.parametrize("size", [3, 7, 1 << 20])
def test_grams_in_slices(monkeypatch, size):
    monkeypatch.setattr(langid, "SLICE", size)
    rng = random.Random(size)
    for text in [None, "", "1", "a", "ab  cd", *("".join(rng.choice("aBé 1日") for _ in range(30)) for _ in range(200))]:
        codes, counts = langid.gram_counts(text)

        def name(code):
            points = [code >> 42, code >> 21 & 0x1FFFFF, code & 0x1FFFFF]
            return "".join(chr(p) for p in points if p)

        got = Counter({name(c): n for c, n in zip(codes.tolist(), counts.tolist())})
        got.pop("\x01", None)
        # at both ends of the text there is one edge, whatever stands there
        assert {k: v for k, v in got.items() if k.strip("\x01")} == dict(brute_grams(text))


def test_language_of_held_out_documents(tables):
    docs = tables["documents"]
    out = langid.held_out(docs["doc_id"], 5, 0)
    profiles = langid.learn(docs.filter(~out).select("doc_id", "text", "lang"))
    rows = langid.identify(docs.filter(out), profiles).select("row.lang", "lang_pred", "score").collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in rows]) > 0.95
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_language_of_odd_input(odd):
    profiles = langid.learn(odd.select("doc_id", "text", "lang"))
    rows = langid.identify(odd, profiles).collect()
    assert len(rows) == odd.count()
    for r in rows:
        if not any(c.isalpha() for c in r["row"]["text"] or ""):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
    nothing = langid.learn(odd.limit(0).select("doc_id", "text", "lang"))
    assert {r["lang_pred"] for r in langid.identify(odd, nothing).collect()} == {"und"}
    assert langid.identify(odd.limit(0), profiles).count() == 0


# --- toxicity ---------------------------------------------------------------------
def test_toxic_words_are_learned(spark):
    rng = random.Random(6)
    letters = "bcdfgklmnprst"
    words = [a + o + b + e for a, o, b, e in itertools.product(letters, "aeou", letters, "ai")]
    rows, labels = [], []
    for i in range(1500):
        text = [rng.choice(words) for _ in range(40)]
        toxic = i % 9 == 0
        if toxic:
            text[3:5] = [rng.choice(["idiot", "scumbag"]), rng.choice(["zxq" + w for w in ("en", "ung", "ish")])]
        rows.append((i, " ".join(text)))
        if i % 2 == 0 or toxic:
            labels.append((i, int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame(labels + [(0, 0)], "doc_id long, toxic int")
    scorers = toxicity.train(toxicity.teachers(docs), toxicity.teachers(marks))
    out = toxicity.score(docs, scorers).withColumn("out", langid.held_out(F.col("doc_id"), 4, 2)).collect()
    held = [r for r in out if r["out"]]
    assert all((r["score"] >= 0.3) == (r["doc_id"] % 9 == 0) for r in held)


def test_negative_risk_does_not_go_on_falling():
    """A feature of every positive and of nothing else: probabilities stay near the truth."""
    toxic = [toxicity.text_features("bad plain")] * 30
    mixed = [toxicity.text_features("plain text")] * 270 + toxic
    features, weights, bias = toxicity.fit(toxic, mixed, prior=0.1)
    scorers = toxicity.Scorers([(features, weights, bias)])
    score = scorers.scorer()
    assert score("bad plain") > 0.8 and score("plain text") < 0.3 and score(None) < 0.3


def test_toxicity_of_odd_input(spark, odd):
    none = toxicity.train(odd, spark.createDataFrame([], "doc_id long, toxic int"))
    rows = toxicity.score(odd, none).collect()
    assert len(rows) == odd.count() and {r["score"] for r in rows} == {0.0}
    marks = spark.createDataFrame([(4, 1), (4, 0), (6, 0), (None, 1), (7, None)], "doc_id long, toxic int")
    rows = toxicity.score(odd, toxicity.train(odd, marks)).collect()
    assert len(rows) == odd.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert toxicity.score(odd.limit(0), none).count() == 0


# --- SimHash ----------------------------------------------------------------------
def brute_components(nodes, linked):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in itertools.combinations(nodes, 2):
        if linked(a, b):
            a, b = sorted((root(a), root(b)))
            parent[b] = a
    return {n: root(n) for n in nodes}


def test_fingerprint_bits():
    from xxhash import xxh64_intdigest

    words = "One two THREE four five two three four".split()
    hashes = [xxh64_intdigest(" ".join(words[i : i + 3]).lower(), 42) for i in range(len(words) - 2)]
    want = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    assert simhash.fingerprint("One two THREE  four\nfive two three four ") == want
    assert simhash.fingerprint(None) == simhash.fingerprint(" \n") == 0
    assert simhash.fingerprint("A b") == xxh64_intdigest("a b", 42)


@pytest.mark.parametrize("unit", [8192, 12])
def test_links_are_complete(spark, unit):
    rng = random.Random(9)
    prints = {0, 2**64 - 1, 1, 3}
    for _ in range(5):
        centre = rng.getrandbits(64)
        for _ in range(60):
            prints.add(centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 5))))
    prints = sorted(prints)
    signed = [p - 2**64 if p >= 2**63 else p for p in prints]
    rows = [(i, 0, p) for i, p in enumerate(signed)] + [(1000, 0, signed[0]), (None, 0, signed[1])]
    df = spark.createDataFrame(rows, "doc_id long, text_hash long, fp long")
    got = simhash.near_duplicates(df, unit=unit).collect()
    want = brute_components(range(len(prints)), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 2)
    place = {p: i for i, p in enumerate(signed)}
    assert len(got) == len(rows)
    assert all(r["component_id"] == want[place[r["fp"]]] for r in got)


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 102), (102, 101), (100, 102)], "a long, b long")
    got = {r["node"]: r["root"] for r in components.components(edges).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100, 102: 100}
    assert components.components(edges.limit(0)).count() == 0


def test_one_document_of_each_group_stays(odd):
    kept = simhash.keep_one(odd)
    assert kept.columns == odd.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert ids.count(4) == 1 and 1 in ids and 2 not in ids and 3 not in ids
    assert simhash.keep_one(odd.limit(0)).count() == 0


def test_near_duplicates_by_exact_likeness(spark, odd, monkeypatch):
    """The pipeline's stage against brute force: copies with changed words, at and around 0.8."""
    pipeline = pytest.importorskip("corpus_pipeline")
    monkeypatch.setattr(near_dup, "CHUNK", 8)
    rng = random.Random(12)
    texts = []
    for _ in range(12):
        words = [f"w{rng.randrange(10**6)}" for _ in range(120)]
        texts.append(" ".join(words))
        for changes in (1, 1, 2, 2, 3, 3, 4, 5):
            other = list(words)
            for at in rng.sample(range(120), changes):
                other[at] = f"x{rng.randrange(10**6)}"
            texts.append(" ".join(other))
        texts.append(texts[-1])

    def grams(text):
        words = text.split()
        return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}

    sets = [grams(t) for t in texts]
    want = brute_components(range(len(texts)), lambda a, b: len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]))
    docs = spark.createDataFrame([(i, t, i) for i, t in enumerate(texts)], "doc_id long, text string, row int")
    kept = pipeline.near_duplicates(spark, docs, "")
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(want.values()))
    ids = [r["doc_id"] for r in pipeline.near_duplicates(spark, odd, "").collect()]
    assert ids.count(4) == 1 and 1 in ids and 2 not in ids and 3 not in ids
    assert pipeline.near_duplicates(spark, odd.limit(0), "").count() == 0


# --- pages ------------------------------------------------------------------------
def test_shared_lines_are_a_longest_common_subsequence():
    rng = random.Random(3)
    for _ in range(1500):
        a, b = ([rng.choice("abcdef") for _ in range(rng.randint(0, 12))] for _ in "ab")
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        found = sorted(page_diff.shared(a, b))
        rest = iter(b)
        assert len(found) == table[-1][-1] and all(a[i] in rest for i in found)


def page(*lines, main=""):
    return "<html><body>" + "".join(f"<div>{x}</div>" for x in lines) + main + "</body></html>"


def test_template_lines_go_and_content_stays(spark):
    rows = [
        (1, "http://h/a/1", page("Top", "Own  one", "Bottom")),
        (2, "http://h/a/2", page("Top", "Own<br>two", "Bottom")),
        (3, "http://h/b", page("Top", "third", "Bottom")),
        (4, "http://alone/", page("Top", "only")),
        (5, "http://m/1", page("Top", main="<article><h1>T</h1><p>Said</article><div>x</div>")),
        (6, "http://m/2", page("Top", main="<article><h1>U</h1><p>Said<nav>no</nav><p>&amp;amp</article><div>y</div>")),
        (7, "http://m/2", page("Top", main="<article><h1>U</h1><p>Said<nav>no</nav><p>&amp;amp</article><div>y</div>")),
        (8, None, None), (None, None, ""), (9, "http://z/", "<p class='cookie-notice'>no</p><p>yes <script>x</script>"),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit(1))
    got = {r["page_id"]: r["text"] for r in page_diff.extract(pages).collect()}
    assert got[1] == "Own one" and got[2] == "Own two" and got[3] == "third"
    assert got[4] == "Top\nonly" and got[8] == got[None] == "" and got[9] == "yes"
    assert got[5] == "T\nSaid\nx" and all("U\nSaid\n&amp\ny" in got[k] for k in (6, 7))
    assert page_diff.extract(pages.limit(0)).count() == 0


def test_pairs_do_not_depend_on_the_partitions(spark, tables):
    pages = spark.createDataFrame(
        [(i, f"http://h{i % 2}/{i:03d}", page("Top", f"own {i}", f"part {i // 10}")) for i in range(120)],
        "page_id long, url string, html string",
    )
    seen = set()
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in ("1", "7"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
            seen.add(tuple(sorted((r["page_id"], r["text"]) for r in page_diff.extract(pages).collect())))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(seen) == 1 and dict(next(iter(seen)))[57].startswith("own 57")


@pytest.mark.parametrize("name", ["site-main no-sidebar", "content has-sidebar", "post comments-open", "post category-social", "sidebar"])
def test_class_words_do_not_hide_the_main_element(name):
    def read(html):
        return [t for t, _ in page_diff.blocks(html)]

    for tag in ("article", "main"):
        assert read(f"<{tag} class='{name}'><p>Text <b>here</b></{tag}>") == ["Text here"]
        wrapped = f"<div class='{name}'><p>Lead</p><{tag}><p>Text</p><div class='ad'>no</div></{tag}></div>"
        assert read(wrapped + "<div class='top sidebar'>no</div><p>a <span class='cookie-notice'>no</span> b") == ["Lead", "Text", "a b"]


def test_copies_under_other_paths_are_one_page(spark):
    same = page("Top", "Own words", "Bottom")
    rows = [(i, f"http://h/a/{i:03d}?utm={i}", same) for i in range(90)]
    rows += [(100, "http://h/z", page("Top", "other", "Bottom")), (101, "http://copies/1", same), (102, "http://copies/2", same)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in ("1", "7"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            got = {r["page_id"]: r["text"] for r in page_diff.extract(pages).collect()}
            assert {got.pop(k) for k in (101, 102)} == {"Top\nOwn words\nBottom"} and got.pop(100) == "other"
            assert len(got) == 90 and set(got.values()) == {"Own words"}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_articles_of_the_sample_pages(tables):
    from html import unescape

    pages = {r["page_id"]: r["html"] for r in tables["pages"].collect()}
    rows = page_diff.extract(tables["pages"]).collect()
    assert len(rows) == len(pages)
    for r in rows:
        article = re.search(r"<article>(.*?)(</article>|$)", pages[r["page_id"]], re.S)[1]
        parts = [" ".join(unescape(re.sub(r"<[^>]*>", "", x)).split()) for x in re.split(r"</?h1>|</?p>", article)]
        assert r["text"] == "\n".join(x for x in parts if x) and r["n_chars"] == len(r["text"])


# --- neighbours ---------------------------------------------------------------------
def brute_nearest(ids, x, query, k):
    score = np.zeros(len(ids))
    for d in range(x.shape[1]):
        score += x[query, d] * x[:, d]
    order = np.lexsort((ids, -score))
    return [(int(ids[i]), float(score[i])) for i in order if ids[i] != ids[query]][:k]


def test_recall_and_scores(tables):
    got = {}
    for r in ann.nearest(tables["embeddings"], F.col("vec_id") % 20 == 0).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    data = tables["embeddings"].toPandas()
    ids, x = data["vec_id"].to_numpy(), np.array(data["embedding"].tolist(), float)
    hits = 0
    for i in np.flatnonzero(ids % 20 == 0):
        found = sorted(got[ids[i]])
        want = dict(brute_nearest(ids, x, i, len(ids)))
        assert [r for r, _, _ in found] == list(range(1, 21))
        assert all(want[v] == s for _, v, s in found), "scores are exact"
        hits += len({v for _, v, _ in found} & set(list(want)[:20]))
    assert hits / 20 / len(got) >= 0.9


def test_copies_fill_many_chunks(spark, monkeypatch):
    monkeypatch.setattr(ann, "CHUNK", 16)
    monkeypatch.setattr(ann, "QUERY_CHUNK", 4)
    rng = np.random.default_rng(3)
    rows = [(i, [1.0, 0.5, 0.25] if i < 200 else rng.normal(size=3).tolist()) for i in range(300)]
    rows += [(5, [1.0, 0.5, 0.25]), (301, None), (302, []), (303, [0.0, 0.0, 0.0]), (304, [1.0, None, 1.0]),
             (305, [float("nan"), 1.0, 1.0]), (306, [float("inf"), 1.0, 1.0]), (None, [1.0, 1.0, 1.0]), (320, [1.0])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("list", F.lit("x"))
    got = {}
    for r in ann.nearest(vectors, F.col("vec_id") % 20 == 0).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"]))
    assert set(got) == set(range(0, 300, 20))
    best = ann.nearest(vectors.filter("vec_id < 200"), F.col("vec_id") == 40).orderBy("rank").collect()
    assert [r["vec_id"] for r in best] == list(range(20)), "ties go to the smaller vec_id"
    few = ann.nearest(vectors.filter("vec_id >= 290 and vec_id < 300"), F.col("vec_id") == 290).collect()
    assert len(few) == 9
    assert ann.nearest(vectors.limit(0), F.col("vec_id") == 0).count() == 0


# --- pipeline -----------------------------------------------------------------------
@pytest.mark.parametrize("chunk", [8, 1024])
def test_a_large_group_of_near_copies_gives_fewer_links_than_members(spark, monkeypatch, chunk):
    """Copies at about the limit, which the first round leaves in many components."""
    monkeypatch.setattr(near_dup, "CHUNK", chunk)
    rng, n = random.Random(9), 120
    words = [f"w{i}" for i in range(100)]
    texts = []
    for _ in range(n):
        other = list(words)
        for at in rng.sample(range(100), 2):
            other[at] = f"x{rng.randrange(10**6)}"
        texts.append(" ".join(other))
    described = near_dup.with_bands(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    nodes = described.select("node", "marks", F.explode("bands").alias("value"))
    sets = near_dup._sets(spark.createDataFrame(list(enumerate(texts)), "node long, text string"))
    numbered = {r["node"]: i for i, r in enumerate(described.orderBy("doc_id").collect())}
    members = spark.createDataFrame([(numbered[r["node"]], bytes(r["marks"]), r["value"]) for r in nodes.collect()], "node long, marks binary, value long")
    none = spark.createDataFrame([], "node long, root long")
    per_bucket = Counter(r["value"] for r in members.select("value").collect())
    links = [tuple(r) for r in near_dup.links_across(members, none, sets).collect()]
    chunks = -(-n // chunk)
    assert len(links) <= sum(m - 1 for m in per_bucket.values() if m > 1) * chunks
    hashes = [set(near_dup.hashed(t).tolist()) for t in texts]

    def near(a, b):
        return len(hashes[a] & hashes[b]) >= 0.8 * len(hashes[a] | hashes[b])

    assert all(near(a, b) for a, b in links)
    linked = set(links) | {(b, a) for a, b in links}
    assert brute_components(range(n), near) == brute_components(range(n), lambda a, b: (a, b) in linked)


def test_pipeline_against_the_operators_one_by_one(spark, sf_dir):
    pipeline = pytest.importorskip("corpus_pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, kept = docs.columns, [docs.count()]
    for name, stage in pipeline.STAGES[:-1]:
        before = docs
        docs = stage(spark, docs, sf_dir).cache()
        assert docs.columns == columns
        kept.append(docs.count())
        ids = {r[0] for r in docs.select("doc_id").collect()}
        assert ids <= {r[0] for r in before.select("doc_id").collect()}
        if "SimHash" in name:
            sets = [(r["doc_id"], set(near_dup.hashed(r["text"]).tolist())) for r in before.select("doc_id", "text").collect()]
            groups = brute_components(
                range(len(sets)), lambda a, b: len(sets[a][1] & sets[b][1]) >= 0.8 * len(sets[a][1] | sets[b][1])
            )
            least = {}
            for i, (d, _) in enumerate(sets):
                least[groups[i]] = min(least.get(groups[i], d), d)
            assert ids == set(least.values())
    assert kept[1] < kept[0] and kept[3] < kept[2]
    pieces = pipeline.STAGES[-1][1](spark, docs, sf_dir)
    assert pieces.agg(F.sum("length")).first()[0] == pieces.select("doc_id", "doc_tokens", "start").filter("start = 0").agg(F.sum("doc_tokens")).first()[0]
    assert pipeline.run(spark, sf_dir).agg(F.sum("length")).first()[0] == pieces.agg(F.sum("length")).first()[0]


# --- learned parts against plain versions --------------------------------------------------
def test_field_is_fitted_to_the_likelihood_of_all_label_sequences():
    """At the fitted weights, the slope of the log-likelihood by enumeration is that of the penalty."""
    rng = np.random.default_rng(2)
    docs = [rng.random((n, line_quality.FEATURES)) for n in (1, 2, 3, 4, 4)]
    labels = [(d[:, 0] + rng.random(len(d)) * 0.5 > 0.8).astype(int) for d in docs]
    field = line_quality.fit(docs, labels, epochs=3000, rate=0.05, decay=0.05)

    def likelihood(w, steps, start):
        total = 0.0
        for x, y in zip(docs, labels):
            def score(seq):
                emit = sum(x[t] @ w[:, k] for t, k in enumerate(seq))
                return emit + start[seq[0]] + sum(steps[a, b] for a, b in zip(seq, seq[1:]))

            every = [score(seq) for seq in itertools.product((0, 1), repeat=len(x))]
            total += score(tuple(y)) - np.logaddexp.reduce(every)
        return total / sum(map(len, docs))

    params = [field.weights, field.steps, field.start]
    for k, p in enumerate(params):
        for at in list(np.ndindex(p.shape))[:8]:
            sides = []
            for step in (1e-5, -1e-5):
                moved = [q.copy() for q in params]
                moved[k][at] += step
                sides.append(likelihood(*moved))
            slope = (sides[0] - sides[1]) / 2e-5
            assert abs(slope - 0.05 * p[at]) < 2e-3


def test_decoding_finds_the_best_of_all_label_sequences():
    rng = np.random.default_rng(3)
    for _ in range(60):
        field = line_quality.Field(np.zeros((1, 2)), rng.normal(size=(2, 2)), rng.normal(size=2))
        scores = rng.normal(size=(rng.integers(1, 8), 2))

        def value(seq):
            steps = sum(field.steps[a, b] for a, b in zip(seq, seq[1:]))
            return sum(scores[t, k] for t, k in enumerate(seq)) + field.start[seq[0]] + steps

        best = max(itertools.product((0, 1), repeat=len(scores)), key=value)
        assert tuple(field.decode(scores)) == best


def test_whole_texts_teach_in_overlapping_chunks():
    lines = np.arange(300 * line_quality.FEATURES, dtype=np.float32).reshape(300, -1)
    parts = line_quality.chunks(lines)
    assert all((a[-1] == b[0]).all() for a, b in zip(parts, parts[1:]))
    assert (np.concatenate([parts[0], *(p[1:] for p in parts[1:])]) == lines).all()
    assert line_quality.chunks(lines[:0]) == [] and len(line_quality.chunks(lines[:1])) == 1


def test_language_distance_against_sums_over_ranks():
    texts = {"a": "the cat and the dog and the bird", "b": "le chat et le chien et le merle", "c": "der hund und die katze"}
    grams = {}
    for name, text in texts.items():
        codes, counts = (x.tolist() for x in langid.gram_counts(text))
        grams[name] = [c for c, _ in sorted(zip(codes, counts), key=lambda p: (-p[1], p[0]))]
    size, document = 25, 12
    profiles = langid.Profiles({n: g[:size] for n, g in grams.items()}, size, document)
    for text in [*texts.values(), "the dog", "katze und le dog", "zzz qqq"]:
        codes, counts = (x.tolist() for x in langid.gram_counts(text))
        own = [c for c, _ in sorted(zip(codes, counts), key=lambda p: (-p[1], p[0]))][:document]
        far = {}
        for name in sorted(texts):
            ranks = {c: i for i, c in enumerate(grams[name][:size])}
            far[name] = sum(min(size, abs(ranks[c] - i)) if c in ranks else size for i, c in enumerate(own))
        best = min(sorted(far), key=far.get)
        name, score = profiles.predict(text)
        assert name == best and score == pytest.approx(1 - far[best] / (size * len(own)))


def test_toxic_scorer_against_a_plain_risk():
    """The fitted scorer has a lower non-negative risk than any one-weight change of it by half."""
    rng = random.Random(4)
    clean, bad = [f"plain{i}" for i in range(40)], [f"vile{i}" for i in range(6)]
    toxic = [" ".join(rng.sample(clean, 5) + rng.sample(bad, 2)) for _ in range(60)]
    unlabelled = [" ".join(rng.sample(clean, 6)) for _ in range(200)] + toxic[:20]
    features = [[toxicity.text_features(t) for t in part] for part in (toxic, unlabelled)]
    prior = 20 / 220
    chosen, weights, bias = toxicity.fit(*features, prior, decay=0.0)
    assert len(chosen)
    place = {int(f): i for i, f in enumerate(chosen)}

    def risk(w, b):
        z = [[sum(w[place[f]] for f in doc.tolist() if f in place) + b for doc in part] for part in features]
        as_toxic = np.logaddexp(0, -np.array(z[0])).mean()
        negative = np.logaddexp(0, np.array(z[1])).mean() - prior * np.logaddexp(0, np.array(z[0])).mean()
        return prior * as_toxic + max(0.0, negative)

    fitted = risk(weights, bias)
    assert fitted < risk(np.zeros_like(weights), np.log(prior / (1 - prior)))
    scorer = toxicity.Scorers([(chosen, weights, bias)]).scorer()
    for text, doc in zip(toxic[:5] + unlabelled[:5], features[0][:5] + features[1][:5]):
        z = sum(weights[place[f]] for f in doc.tolist() if f in place) + bias
        assert scorer(text) == pytest.approx(1 / (1 + np.exp(-z)))
    assert min(map(scorer, toxic)) > max(map(scorer, unlabelled[:200]))


# --- page furniture ------------------------------------------------------------------------
def lines_of(html):
    return [t for t, _ in page_diff.blocks(html)]


@pytest.mark.parametrize("name", ["comment-list", "commentlist", "comment-body", "user-comments", "site-footer", "top-menu", "comments"])
def test_reader_comments_and_menus_inside_an_article_go(name):
    assert lines_of(f"<article><p>Text<div class='{name}'><p>no</p></div><p>End</article>") == ["Text", "End"]
    assert lines_of(f"<article><p>Text<ul id='{name}'><li>no</ul></article>") == ["Text"]


def test_a_comment_thread_by_its_id_goes():
    assert lines_of("<article><p>Text<div id='disqus_thread'>no</div></article>") == ["Text"]


@pytest.mark.parametrize("part", ["<p class='navy'>x</p>", "<section class='search'>x</section>", "<p id='related'>x</p>", "<header><h1>x</h1></header>"])
def test_parts_of_an_article_stay(part):
    assert lines_of(f"<article>{part}<p>Text</article>") == ["x", "Text"]


@pytest.mark.parametrize("tag", ["nav", "header", "form"])
def test_an_unclosed_tag_before_the_article_does_not_hide_it(tag):
    assert lines_of(f"<{tag}><a href='/'>Home</a><article><h1>T</h1><p>Text</p></article>") == ["T", "Text"]
    assert lines_of("<aside><article><p>teaser</p></article></aside><p>Text") == ["Text"]


def test_differencing_removes_template_lines_that_no_class_names(spark):
    def template(i, body):
        return f"<div class='x1'>Site</div><div>Lead of all</div>{body}<div>Terms apply</div><div class='q'>Call us</div>"

    rows = [(i, f"http://h/a/{i:02d}", template(i, f"<p>Own {i}</p><p>A passage that all share</p><p>End {i}</p>")) for i in range(12)]
    rows += [(50, "http://h/b", "<article><p>Own</p><p>A passage that all share</p></article><div>Terms apply</div>")]
    rows += [(51, "http://deep/1", "<div>" * 3000 + "deep"), (52, "http://deep/2", "<p>long " * 20000), (None, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("texts", F.lit("clash"))
    got = {r["page_id"]: (r["text"], r["n_chars"]) for r in page_diff.extract(pages).collect()}
    for i in range(12):
        assert got[i][0] == f"Own {i}\nEnd {i}" and got[i][1] == len(got[i][0])
    assert got[50][0] == "Own\nA passage that all share", "what stands in the article stays"
    assert got[51] == ("deep", 4) and got[52][1] == 20000 * 5 - 1 and got[None] == ("", 0)
