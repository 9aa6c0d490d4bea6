"""Merkle manifest, best-fit packing and periodic runs against plain versions, and odd input."""

import bisect
import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from vitalflow.llm import best_fit, merkle, ordering, periodic_runs, queries
from vitalflow.llm.common import materialise
from vitalflow.llm.tokens import Encoder

DOCS = "doc_id long, source string, lang string, n_chars long, text string, h string, at int, digest string"


@pytest.fixture(scope="module")
def docs(spark):
    """Nulls, empty and long texts, ties, repeated rows, a hot source, clashing names."""
    queries.prepare(spark)
    rng = random.Random(1)
    rows = [(i, rng.choice(["a", "b", "b", "b", None, "é"]), rng.choice(["en", None]), i, rng.choice(["Abc é", "low", None, ""])) for i in range(500)]
    rows += rows[:40] + [(None, "b", "x", 1, "T")] * 3 + [(10**6 + i, f"s{i}", "x", None, "T x T x T x T x T x") for i in range(30)]
    rows += [(7, "b", None, 0, "Other text of an id that is there"), (8, "b", "en", 1, "Word " * 9000), (9, "b", "en", 1, "ab " * 30)]
    return spark.createDataFrame([(*r, "clash", 1, "clash") for r in rows], DOCS)


def rows_of(docs):
    return [tuple(r)[:5] for r in docs.collect()]


# --- positions --------------------------------------------------------------------------
def test_positions_number_equal_rows_and_nulls_apart(spark):
    rows = [(g, v) for g, n in (("hot", 900), (None, 50), ("x", 1)) for v in [random.Random(n).randrange(5) for _ in range(n)]]
    df = materialise(spark.createDataFrame(rows, "g string, v int").repartition(5), "rows")
    found = ordering.positions(df, "g", ["v"], "at", "size", "order").collect()
    by_group = defaultdict(list)
    for r in found:
        by_group[r["g"]].append((r["at"], r["v"], r["size"]))
    for group, got in by_group.items():
        got.sort()
        assert [a for a, _, _ in got] == list(range(len(got))) and {s for _, _, s in got} == {len(got)}
        assert [v for _, v, _ in got] == sorted(v for g, v in rows if g == group)


# --- Merkle manifest ------------------------------------------------------------------------
def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_manifest(rows, arity):
    def leaf(row):
        return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))

    def climb(nodes, at):
        path = []
        while len(nodes) > 1:
            runs = [nodes[i : i + arity] for i in range(0, len(nodes), arity)]
            path.append((runs[at // arity], at % arity))
            nodes, at = [sha("".join(r)) for r in runs], at // arity
        return nodes[0], path

    groups = defaultdict(list)
    for row in rows:
        groups[row[1]].append((row[0], leaf(row), row))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for name in names:
        groups[name].sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1]))
    subroots = [climb([t[1] for t in groups[n]], 0)[0] for n in names]
    out = []
    for k, name in enumerate(names):
        for i, (doc, own, row) in enumerate(groups[name]):
            path = climb([t[1] for t in groups[name]], i)[1]
            root, upper = climb(subroots, k)
            now = own
            if doc is not None and zlib.crc32(str(doc).encode()) % 5 == 0 and row[4] is not None:
                now = leaf((*row[:4], re.sub("[A-Z]", lambda m: m[0].lower(), row[4])))
            proof = ""
            for run, slot in path + upper:
                proof += "".join(run[:slot] + run[slot + 1 :])
                now = sha("".join([*run[:slot], now, *run[slot + 1 :]]))
            out.append((doc, name, own, subroots[k], root, sha(proof), now, now == root))
    return sorted(out, key=str)


@pytest.mark.parametrize("arity, levels", [(16, 3), (16, 1), (3, 2)])
def test_manifest_against_whole_lists(docs, arity, levels):
    got = merkle.manifest(docs, merkle.DOCUMENT_COLUMNS, "source", "doc_id", merkle.tampered_documents(docs), arity, levels)
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain_manifest(rows_of(docs), arity)


def test_manifest_of_one_row_and_of_none(docs):
    one = merkle.manifest(docs.filter("doc_id = 9 and n_chars = 1"), merkle.DOCUMENT_COLUMNS, "source", "doc_id").first()
    assert one["leaf"] == one["subroot"] == one["root"] == one["folded_root"] and one["proof_sha256"] == sha("")
    assert merkle.manifest(docs.limit(0), merkle.DOCUMENT_COLUMNS, "source", "doc_id").count() == 0


def test_a_fold_hashes_what_stands_right_of_the_slot_only():
    children = [sha(str(i)).encode() for i in range(16)]
    parent = merkle.Parent(b"".join(children))
    for slot, state in enumerate(parent.states):
        place = merkle.Slot(state, parent.children, slot)
        assert place.fold(children[slot]) == parent.digest and len(place.right) == 64 * (15 - slot)
        assert merkle.slot_on_path(slot, parent.children).fold(b"0" * 64) == place.fold(b"0" * 64)


# --- best-fit packing -------------------------------------------------------------------------
def plain_best_fit(sizes, capacity):
    rooms = []
    for size in sorted(sizes, reverse=True):
        at = bisect.bisect_left(rooms, size)
        room = rooms.pop(at) if at < len(rooms) else capacity
        bisect.insort(rooms, room - size)
    return rooms


def test_the_plan_is_that_of_one_piece_after_the_other():
    rng = random.Random(3)
    for _ in range(300):
        capacity = rng.choice([1, 5, 16, 17, 64, 100])
        sizes = [rng.randint(1, capacity if rng.random() < 0.5 else max(1, capacity // 4)) for _ in range(rng.randint(0, 90))]
        counts = Counter(sizes)
        moves, windows = best_fit.plan(counts.items(), capacity).tolist(), defaultdict(list)
        for size, n in counts.items():
            own = [m for m in moves if m[0] == size]
            for at in range(n):
                _, first, each, window, offset = [m for m in own if m[1] <= at][-1]
                windows[window + (at - first) // each].append((offset + (at - first) % each * size, size))
        rooms = []
        for pieces in windows.values():
            filled = 0
            for offset, size in sorted(pieces):
                assert offset == filled
                filled += size
            rooms.append(capacity - filled)
        assert sorted(rooms) == plain_best_fit(sizes, capacity) and sorted(windows) == list(range(len(windows)))


def test_the_plan_stays_small_for_any_number_of_pieces():
    assert len(best_fit.plan([(s, 10**9 + s) for s in range(1, 4097)], 4096)) < 20_000


def test_best_fit_covers_every_id_once(docs, sf_dir, spark):
    path = queries.tokenizer_path("word_bpe_49k.json")
    encoder = Encoder(path)
    for rows, capacity in ((docs, 512), (spark.read.parquet(f"{sf_dir}/documents.parquet"), 4096)):
        pieces = best_fit.pack(rows, path, capacity).collect()
        texts = Counter((r["doc_id"], r["text"]) for r in rows.select("doc_id", "text").collect())
        want = Counter()
        for (doc, text), times in texts.items():
            ids = encoder.whole.encode(text or "", add_special_tokens=False).ids + [1]
            for k, at in enumerate(range(0, len(ids), capacity)):
                part = ids[at : at + capacity]
                want[doc, k, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += times
        assert Counter(tuple(p)[:5] for p in pieces) == want
        windows = defaultdict(list)
        for p in pieces:
            windows[p["sequence_id"]].append((p["offset"], p["length"]))
        for parts in windows.values():
            parts.sort()
            assert parts[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(parts, parts[1:]))
            assert sum(n for _, n in parts) <= capacity
        assert len(windows) == len(plain_best_fit([p["length"] for p in pieces], capacity))
    assert best_fit.pack(docs.limit(0), path).count() == 0


# --- periodic runs ----------------------------------------------------------------------------
def plain_runs(words):
    found = {}
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j + q - i >= 4 * q:
                found.setdefault((i, j + q), q)
            i = max(j, i) + 1
    return [(a, b - a, q) for (a, b), q in sorted(found.items())]


def repetitive(rng):
    letters = rng.choice([1, 2, 3, 5, 50])
    words = [rng.randrange(letters) for _ in range(rng.randint(0, rng.choice([8, 60, 300])))]
    for _ in range(rng.randint(0, 4)):
        period = rng.randint(1, rng.choice([2, 6, 40]))
        base = [rng.randrange(letters) for _ in range(period)]
        part = (base * rng.randint(2, 9))[: rng.randint(1, period * 9)]
        at = rng.randint(0, len(words))
        words[at:at] = part
    if rng.random() < 0.1:  # a Fibonacci word, full of overlapping repetitions
        a, b = [0], [0, 1]
        for _ in range(rng.randint(3, 10)):
            a, b = b, b + a
        words = b * rng.randint(1, 5)
    return words


def test_runs_against_every_period_at_every_place():
    rng, runs = random.Random(5), 0
    for _ in range(60):
        texts = [repetitive(rng) for _ in range(rng.randint(1, 25))]
        want = [plain_runs(t) for t in texts]
        assert periodic_runs.runs_of([np.array(t, np.int64) for t in texts]) == want
        runs += sum(map(len, want))
    assert runs > 1000 and periodic_runs.runs_of([]) == []


def plain_digests(doc, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    if doc is not None and n and zlib.crc32(str(doc).encode()) % 10 == 0:
        g = zlib.crc32(str(doc).encode()) // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    runs = [r for r in plain_runs(words) if r[1] >= max(6, 4 * r[2])]
    dropped = {i for start, length, q in runs for i in range(start + q, start + length)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None,) * 3
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
    return (doc, len(runs), *best, 1000 * best[1] // best[2] if runs else None, sha(lines), sha(kept))


def test_periodic_runs_query_against_plain(docs, sf_dir, spark):
    rng = random.Random(6)
    more = [(10**7 + i, " ".join(f"w{x}" for x in repetitive(rng))) for i in range(200)]
    tables = [docs.filter("n_chars is null or n_chars <> 1 or doc_id <> 8"), spark.createDataFrame(more, "doc_id long, text string")]
    for table in [*tables, spark.read.parquet(f"{sf_dir}/documents.parquet").filter(F.length("text") < 4000)]:
        got = periodic_runs.digests(periodic_runs.detect(periodic_runs.with_planted_runs(table)))
        want = [plain_digests(r["doc_id"], r["text"]) for r in table.select("doc_id", "text").collect()]
        assert Counter(tuple(r) for r in got.collect()) == Counter(want)
    long = periodic_runs.detect(docs.filter("doc_id = 8 and lang = 'en' and n_chars = 1")).first()
    assert long["n_words"] == 9000 and long["collapsed"] == "Word" and tuple(long["runs"][0]) == (0, 9000, 1)
    assert periodic_runs.detect(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        periodic_runs.detect(docs, exponent=3)
