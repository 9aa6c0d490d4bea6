"""Packing, mixing, token store and WARC: exact round trips, brute force, odd input."""

import random
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from vitalflow.llm import mixing, packing, queries, token_store, warc
from vitalflow.llm.tokens import Encoder

DOCS = "doc_id long, text string, lang string, source string, n_chars long, size string, `row` string"
ODD = [
    (1, None, "en", None, 0, "clash", "clash"),
    (2, "", "en", "s1", 0, "x", "x"),
    (3, "one two\nthree", "en", "s1", 3, "x", "x"),
    (3, "one two\nthree", "en", "s1", 3, "x", "x"),
    (None, "no id", None, "s2", 2, "x", "x"),
    (5, "word " * 9000, "en", "s2", 9, "x", "x"),
]


@pytest.fixture(scope="module")
def odd(spark):
    queries.prepare(spark)
    return spark.createDataFrame(ODD, DOCS)


def encoders():
    return {n: Encoder(queries.tokenizer_path(n)) for n in ("byte_bpe_50k.json", "word_bpe_49k.json")}


def library_ids(encoder, text):
    ids = encoder.whole.encode(text or "", add_special_tokens=False).ids
    return struct.pack(f"<{len(ids)}I", *ids)


def test_ids_are_those_of_the_library(spark, sf_dir):
    rng = random.Random(2)
    letters = " \n\t\x1c\xa0 abAB'sl1½é́Σİß.,!?日🙂\u0085<|>"
    texts = ["", " ", "don't  we'll", "İstanbul ŞŞ", "<|endoftext|> <|startoftext|>", "日本 語", "ΣΑΣ Σ", "a \n b"]
    texts += ["".join(rng.choice(letters) for _ in range(rng.randint(1, 40))) for _ in range(1500)]
    western = " \n\t\r abcstmdreveLLSTMD''0123ßÀÉéÿŒœØ.,!?-_#<|>~"
    texts += ["".join(rng.choice(western) for _ in range(rng.randint(1, 60))) for _ in range(3000)]
    texts += [r[0] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").limit(60).collect()]
    for encoder in encoders().values():
        wrong = [t for t in texts if encoder.encode(t) != library_ids(encoder, t)]
        assert not wrong, wrong[:3]


def check_pieces(pieces, docs, capacity, encoder):
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p["doc_id"], p["doc_tokens"]].append(p)
        by_sequence[p["sequence_id"]].append(p)
    for rows in by_sequence.values():
        rows.sort(key=lambda p: p["offset"])
        assert rows[0]["offset"] == 0
        assert all(a["offset"] + a["length"] == b["offset"] for a, b in zip(rows, rows[1:]))
        assert rows[-1]["offset"] + rows[-1]["length"] <= capacity
    want = Counter()
    for doc, text in docs:
        ids = library_ids(encoder, text) + struct.pack("<I", 1)
        want[doc, len(ids) // 4] += len(ids) // 4
        for p in by_doc[doc, len(ids) // 4]:
            part = ids[4 * p["start"] : 4 * (p["start"] + p["length"])]
            assert zlib.crc32(part) == p["ids_crc32"]
    assert {k: sum(p["length"] for p in v) for k, v in by_doc.items()} == dict(want)
    return by_sequence


def test_packing_covers_every_id_once(spark, sf_dir, odd):
    encoder = encoders()["byte_bpe_50k.json"]
    path = queries.tokenizer_path("byte_bpe_50k.json")
    check_pieces(packing.pack(odd, path).collect(), [(r[0], r[1]) for r in ODD], 2048, encoder)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    sequences = check_pieces(packing.pack(docs, path).collect(), rows, 2048, encoder)
    padded = [2048 - sum(p["length"] for p in s) for s in sequences.values()]
    assert sum(1 for p in padded if p) <= docs.rdd.getNumPartitions(), "one padded sequence per task at most"
    assert packing.pack(odd.limit(0), path).count() == 0


def test_level_choice_is_the_least_sum_of_squares():
    rng = random.Random(7)
    packs = packing.SumOfSquares(40)
    for n in range(600):
        size = rng.randint(1, 39)
        counts = packs.counts.copy()

        def after(level):
            now = counts.copy()
            if level:
                now[level] -= 1
            if level + size < 40:
                now[level + size] += 1
            return int((now[1:40] ** 2).sum())

        options = {h: after(h) for h in range(0, 41 - size) if h == 0 or counts[h]}
        assert after(packs.level_for(size)) == min(options.values())
        packs.put(n, size)


def brute_targets(sizes, weights, most):
    """Share by weight, stop at the cap, share the excess again."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    capped, total = set(), sum(sizes.values())
    while True:
        free = [s for s in order if s not in capped]
        left = total - sum(most * sizes[s] for s in capped)
        level = left / sum(weight[s] for s in free) if free else 0
        over = {s for s in free if weight[s] * level > most * sizes[s]}
        if not over:
            return {s: most * sizes[s] if s in capped else weight[s] * level for s in order}
        capped |= over


def test_mixing_targets_and_copies(spark):
    rng = random.Random(3)
    sizes = {None: 40, "a": 2000, "b": 5, "c": 300, "d": 60, "e": 0}
    rows = []
    for source, n in sizes.items():
        rows += [(rng.randint(0, 10**9), " ".join("w" * rng.randint(1, 40)), source) for _ in range(n)]
    rows += [(1, None, "e"), (2, "", "e"), (None, "x", "a"), (9, "same", "a"), (9, "same", "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    mixed = mixing.mix(mixing.measure(docs)).select("row.*", "size", "source_size", "target", "copies").collect()
    assert len(mixed) == len(rows)
    total, got, taken = Counter(), {}, Counter()
    for r in mixed:
        assert r["size"] == len((r["text"] or "").split()) and 0 <= r["copies"] <= 3
        total[r["source"]] += r["size"]
        taken[r["source"]] += r["size"] * r["copies"]
        got[r["source"]] = r["target"]
    want = brute_targets({s: total[s] for s in sizes}, (1, 2, 3), 3)
    for s in sizes:
        assert got[s] == pytest.approx(want[s]) and abs(taken[s] - want[s]) <= 3 * 40 + 0.02 * want[s]
    again = mixing.mix(mixing.measure(docs.repartition(3))).select("row.*", "copies").collect()
    assert Counter((r["doc_id"], r["copies"]) for r in again) == Counter((r["doc_id"], r["copies"]) for r in mixed)


def test_mixing_odd_input(odd):
    mixed = mixing.mix(mixing.measure(odd))
    out = mixing.emit(mixed)
    assert out.columns == odd.columns, "clashing names stay as they were"
    assert mixed.count() == len(ODD)
    assert mixing.emit(mixing.mix(mixing.measure(odd.limit(0)))).count() == 0


def test_token_store_round_trip(spark, odd, tmp_path):
    path = queries.tokenizer_path("word_bpe_49k.json")
    encoder = encoders()["word_bpe_49k.json"]
    for files in (1, 3):
        listed = token_store.write(odd, path, str(tmp_path / f"s{files}"), files=files)
        rows = token_store.read(spark, listed).orderBy("start").collect()
        order = sorted(ODD, key=lambda r: (r[0] is not None, r[0] or 0))
        start = 0
        for row, want in zip(rows, order):
            ids = library_ids(encoder, want[1]) + struct.pack("<I", 1)
            assert (row["doc_id"], row["start"], row["n_tokens"]) == (want[0], start, len(ids) // 4)
            assert row["ids_crc32"] == zlib.crc32(ids)
            start += len(ids) // 4
        assert len(rows) == len(ODD)
    file = token_store.TokenFile(listed[0][1])
    assert file.ids(0) and "dictionary_sha256" in file.header
    assert token_store.read(spark, token_store.write(odd.limit(0), path, str(tmp_path / "none"))).count() == 0


def test_token_store_uses_its_dictionary(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    listed = token_store.write(docs, queries.tokenizer_path("word_bpe_49k.json"), str(tmp_path / "s"), files=1)
    assert token_store.TokenFile(listed[0][1]).header["dictionary_bytes"] > 0
    body = open(listed[0][1], "rb").read()
    spoiled = bytearray(body)
    spoiled[400] ^= 1
    (tmp_path / "bad").write_bytes(bytes(spoiled))
    with pytest.raises(ValueError):
        token_store.TokenFile(str(tmp_path / "bad"))


PAGES = [
    (1, "http://a/x y", "<p>é</p>"), (2, None, "<p>é</p>"), (2, "http://a/2", "<p>é</p>"), (3, "u", None), (4, "", ""),
    (None, "n", "<p>é</p>"), (6, "long", "x" * 300_000), (None, "m", "alone"), (7, "crlf", "a\r\n\r\nb"),
]


def test_warc_round_trip(spark, tmp_path):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").withColumn("digest", F.lit(1))
    archives = warc.write(pages, str(tmp_path / "w"))
    rows = warc.read(spark, archives).collect()
    got = Counter((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in rows)
    best = {}
    for page, _, html in PAGES:
        if page is not None:
            best[html or ""] = max(best.get(html or "", page), page)
    want = Counter()
    for page, _, html in PAGES:
        data, top = (html or "").encode(), best.get(html or "")
        revisit = top is not None and page != top
        want[page, len(data), warc.base32_sha1(data), "revisit" if revisit else "response", top if revisit else None] += 1
    assert got == want
    payloads = Counter()
    for url in archives:
        with open(url, "rb") as stream:
            for headers, payload in warc.WarcReader(stream):
                payloads[payload] += headers["WARC-Type"] == "response"
    assert {p.decode() for p, n in payloads.items() if n} == {h or "" for _, _, h in PAGES}
    assert warc.read(spark, warc.write(pages.limit(0), str(tmp_path / "none"))).count() == 0


def test_warc_minimum_size(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "aa"), (2, "u", "aa")], "page_id long, url string, html string")
    rows = warc.read(spark, warc.write(pages, str(tmp_path / "w"), min_revisit_bytes=3)).collect()
    assert {r["record_type"] for r in rows} == {"response"}


@pytest.mark.parametrize("damage", ["cut", "flip", "length"])
def test_warc_damage_is_found(tmp_path, damage):
    good = warc.record(1, "u", b"payload " * 50, None, False)
    if damage == "cut":
        data = good[:-20]
    else:
        plain = zlib.decompress(good, 31)
        plain = plain.replace(b"payload ", b"paYload ", 1) if damage == "flip" else plain[:-9] + b"\r\n\r\n"
        squeeze = zlib.compressobj(6, zlib.DEFLATED, 31)
        data = squeeze.compress(plain) + squeeze.flush()
    (tmp_path / "f").write_bytes(good + data)
    with open(tmp_path / "f", "rb") as stream, pytest.raises((warc.WarcError, zlib.error)):
        list(warc.WarcReader(stream))


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_added_tokens_in_a_text(name):
    """Expected ids come from an untouched tokenizer of the same file."""
    import json

    from tokenizers import Tokenizer

    from vitalflow.llm import queries, tokens

    path = queries.tokenizer_path(name)
    library, own = Tokenizer.from_file(path), tokens.Encoder(path)
    with open(path, encoding="utf-8") as file:
        added = [t["content"] for t in json.load(file)["added_tokens"]]
    assert added
    for text in [x for t in added for x in (t, f"a {t} b", f"日本 {t}{t} c", t.upper(), t[:-1])]:
        got = np.frombuffer(own.encode(text), "<u4").tolist()
        assert got == library.encode(text, add_special_tokens=False).ids, text


def test_a_payload_length_is_counted_and_compared():
    import gzip
    import io

    whole = warc.record(1, "http://h/1", b"<p>text</p>", None, False)
    ((headers, payload),) = warc.WarcReader(io.BytesIO(whole))
    assert payload == b"<p>text</p>" and headers["X-Payload-Length"] == "11"
    for wrong, counted in ((b"X-Payload-Length: 12", None), (b"X-Other: 1", "11")):
        changed = gzip.compress(gzip.decompress(whole).replace(b"X-Payload-Length: 11", wrong))
        if counted is None:
            with pytest.raises(warc.WarcError):
                list(warc.WarcReader(io.BytesIO(changed)))
        else:
            ((headers, _),) = warc.WarcReader(io.BytesIO(changed))
            assert headers["X-Payload-Length"] == counted
