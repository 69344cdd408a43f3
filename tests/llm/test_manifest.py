"""Exact digests, Merkle manifests and periodic runs against brute force and edge cases."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from headwater.llm import exact_digest, merkle, periodic_runs

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
EDGE = [None, "", " \n\t ", "a", "Ä ä  ﬁ", "a b " * 20_000, "x x x x x x", "x\nx\nx"]


def docs(spark, rows):
    """Documents with columns whose names clash with those of results and helpers."""
    df = spark.createDataFrame(rows, DOCS)
    for name in ("fingerprint", "group_id", "copies", "form", "salt", "leaf", "proof", "tree", "nth", "part", "runs", "collapsed", "start", "a.b"):
        df = df.withColumn(name, F.lit("clash"))
    return df


def edge_rows():
    rows = [(i, t, "en", (None, "", "s", "é")[i % 4], i) for i, t in enumerate(EDGE)]
    return [*rows, rows[3], rows[3], (None, "b", None, None, None), (None, "b", None, None, None), (-5, "z", None, "s", -1)]


def H(s):
    return hashlib.sha256(s.encode()).hexdigest()


# --- 11 exact digests


def brute_canonical(t):
    import unicodedata

    f = unicodedata.normalize("NFKC", unicodedata.normalize("NFKC", t).casefold())
    return re.sub(r"[\s\x1c-\x1f]+", " ", f).strip(" ")


def test_canonical_forms():
    same = ["Straße  ﬁn", "STRASSE fin ", "\x1cstrasse\nFIN", "strasse ﬁn"]
    assert len({exact_digest.canonical(t) for t in same}) == 1
    assert exact_digest.canonical("é") == exact_digest.canonical("É") != exact_digest.canonical("e")
    for t in [*same, "a\x1f b", "ＡＢ　ｃ", "İi", "ᾳͅ", "ẛ̣"]:
        assert exact_digest.canonical(t) == brute_canonical(t)
        assert exact_digest.canonical(exact_digest.canonical(t)) == exact_digest.canonical(t)


def brute_groups(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[brute_canonical(t or "")].append(i)
    return sorted(((i, min([x for x in groups[brute_canonical(t or "")] if x is not None], default=None), len(groups[brute_canonical(t or "")])) for i, t in rows), key=str)


@pytest.mark.parametrize("digits", [32, 1])
def test_groups_equal_brute_force_even_if_digests_clash(spark, digits):
    rng = random.Random(2)
    rows = edge_rows() + [(100 + i, rng.choice(["A b", "a  B", "c", "d" * rng.randrange(4), str(rng.randrange(30))]), "en", "s", 1) for i in range(300)]
    got = exact_digest.exact_groups(docs(spark, rows), digits=digits).select("id", "group_id", "copies").collect()
    assert sorted(map(tuple, got), key=str) == brute_groups([(r[0], r[1]) for r in rows])


def test_known_digests_keep_their_columns(spark):
    rows = [(i, str(i % 7), "en", "s", i) for i in range(60)]
    df = docs(spark, rows)
    known = exact_digest.digests(df, "text", ["doc_id", "n_chars", "a.b"], digits=1).withColumnRenamed("doc_id", "id")
    got = exact_digest.exact_groups(df, known=known, digits=1)
    assert got.columns == ["id", "fingerprint", "n_chars", "a.b", "group_id", "copies"]
    assert sorted((r.id, r.group_id, r.copies) for r in got.collect()) == sorted(brute_groups([(r[0], r[1]) for r in rows]))
    assert all(r.n_chars == r.id for r in got.collect())


def brute_edited(rows):
    out = []
    for k, (i, t) in enumerate(rows):
        after = rows[(k + 1) % len(rows)][1]
        q = len(t) // 4
        e = t[: len(t) - q] + after[:q]
        out.append((i, len(t), H(e), float(brute_canonical(e) == brute_canonical(t)), float(brute_canonical(after) == brute_canonical(t))))
    return sorted(out, key=str)


@pytest.mark.parametrize("parts", [1, 3, 16])
def test_digest_report_meets_successors_over_partitions(spark, parts):
    rng = random.Random(parts)
    rows = [(i * 3, (rng.choice(["alpha ", "BETA ", "é"]) * rng.randrange(9)), "en", "s", 1) for i in range(40)] + [(200, None, "en", "s", 1)]
    rng.shuffle(rows)
    got = exact_digest.digest_report(docs(spark, rows).repartition(parts)).collect()
    assert sorted(((r.doc_id, r.n_chars, r.edited_sha256, r.near_edited, r.near_next) for r in got), key=str) == brute_edited(sorted((r[0], r[1] or "") for r in rows))
    by = {r.doc_id: r for r in got}
    texts = {r[0]: r[1] or "" for r in rows}
    for a in by:
        assert by[a].fingerprint == exact_digest.wide_hash(brute_canonical(texts[a]))


def test_digest_report_edges(spark):
    got = exact_digest.digest_report(docs(spark, edge_rows())).collect()
    assert len(got) == len(edge_rows())
    assert sorted(r.copies for r in got if r.doc_id in (0, 1, 2)) == [3, 3, 3]
    assert {r.group_id for r in got if r.doc_id is None} == {None} and [r.copies for r in got if r.doc_id is None] == [2, 2]
    one = exact_digest.digest_report(docs(spark, [(7, "abcd", "en", "s", 4)])).first()
    assert (one.edited_sha256, one.near_next, one.copies) == (H("abca"), 1.0, 1)
    assert exact_digest.digest_report(docs(spark, [])).collect() == []


# --- 12 Merkle manifest


def enc(*v):
    return "".join("-" if x is None else f"{len(str(x).encode())}:{x}" for x in v)


def up(digests, fanout):
    levels = [digests]
    while len(levels[-1]) > 1:
        levels.append([H("".join(levels[-1][i : i + fanout])) for i in range(0, len(levels[-1]), fanout)])
    return levels


def path(levels, i, fanout):
    out = []
    for level in levels[:-1]:
        lo = i // fanout * fanout
        out.append(("".join(level[lo:i]), "".join(level[i + 1 : lo + fanout])))
        i //= fanout
    return out


def brute_manifest(rows, fanout=3):
    """(doc_id, leaf, subroot, root, proof) by plain lists; rows are (doc_id, source, lang, n_chars, text)."""
    trees = defaultdict(list)
    for r in rows:
        trees[r[1]].append((r[0] is not None, r[0] or 0, H(enc(*r)), r))
    names = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    levels = {s: up([x[2] for x in sorted(trees[s], key=lambda x: x[:3])], fanout) for s in names}
    top = up([levels[s][-1][0] for s in names], fanout)
    for j, s in enumerate(names):
        for i, x in enumerate(sorted(trees[s], key=lambda x: x[:3])):
            yield x[3], x[2], levels[s][-1][0], top[-1][0], path(levels[s], i, fanout) + path(top, j, fanout)


def folded(leaf, proof):
    for a, b in proof:
        leaf = H(a + leaf + b)
    return leaf


def brute_report(rows):
    out = []
    for r, leaf, sub, root, proof in brute_manifest(rows):
        start = leaf
        if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0:
            start = H(enc(*r[:4], None if r[4] is None else r[4].replace("\n", "")))
        end = folded(start, proof)
        out.append((r[0], leaf, sub, root, H("".join(a + b for a, b in proof)), end, end == root))
    return sorted(out, key=str)


def shaped(rows):
    return [(r[0], r[3], r[2], r[4], r[1]) for r in rows]


@pytest.mark.parametrize("n", [0, 1, 2, 3, 4, 9, 10, 28, 200])
def test_manifest_equals_brute_force(spark, n):
    rng = random.Random(n)
    sources = [None, "", "a", "ä", "Z"][: 1 + n % 5]
    rows = [(i * 2 - 5, rng.choice(["x\ny", "x", "", None, "ü\n"]), rng.choice(["en", None]), rng.choice(sources), rng.choice([None, i])) for i in range(n)]
    rng.shuffle(rows)
    got = merkle.merkle_report(docs(spark, rows).repartition(5)).collect()
    assert sorted(map(tuple, got), key=str) == brute_report(shaped(rows))


def test_manifest_edges(spark):
    rows = edge_rows()
    got = merkle.merkle_report(docs(spark, rows)).collect()
    assert sorted(map(tuple, got), key=str) == brute_report(shaped(rows))
    assert {r.verified for r in got if r.doc_id == 7} == {zlib.crc32(b"7") % 2 == 1}


def test_manifest_fanout_kept_columns_and_verification(spark):
    rows = [(i, f"t{i}", "en", "ab"[i % 2], i) for i in range(37)]
    df = docs(spark, rows)
    got = merkle.merkle_manifest(df, ["doc_id", "text", "a.b"], "source", "doc_id", ["doc_id", "a.b", "nth"], fanout=2)
    assert got.columns == ["doc_id", "a.b", "nth", "leaf", "subroot", "root", "proof"]
    checked = got.select((merkle.fold(F.col("leaf"), F.col("proof")) == F.col("root")).alias("ok"), (merkle.fold(merkle.digest(F.lit("no")), F.col("proof")) == F.col("root")).alias("bad"))
    assert {tuple(r) for r in checked.collect()} == {(True, False)}
    first = {r.doc_id: r for r in got.collect()}
    again = merkle.merkle_manifest(df.where("doc_id <> 5"), ["doc_id", "text", "a.b"], "source", "doc_id", ["doc_id"], fanout=2).first()
    assert again.root != first[0].root
    with pytest.raises(ValueError):
        merkle.merkle_manifest(df, ["doc_id"], "source", "doc_id", ["leaf"])


# --- 13 periodic runs


def brute_runs(w, least=6, power=4):
    n, out, seen = len(w), [], set()
    for q in range(1, n // power + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            s = i
            while i + q < n and w[i] == w[i + q]:
                i += 1
            if i + q - s >= max(least, power * q) and (s, i + q) not in seen:
                seen.add((s, i + q))
                out.append((s, i + q - s, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_collapsed(w, runs):
    drop = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in drop)


def words_of(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


def random_text(rng):
    n, a, w = rng.choice([0, 1, 3, 8, 20, 60, 200]), rng.choice([1, 2, 3, 10]), []
    while len(w) < n:
        part = [str(rng.randrange(a)) for _ in range(rng.randint(1, 7))]
        w += part * rng.choice([1, 2, 3, 4, 5, 9])
    return " ".join(w[:n])


@pytest.mark.parametrize(("least", "power"), [(6, 4), (1, 4), (10, 5)])
def test_runs_equal_brute_force(least, power):
    rng = random.Random(power + least)
    for _ in range(300):
        texts = [random_text(rng) for _ in range(rng.randint(1, 5))]
        for t, runs, kept in zip(texts, *periodic_runs._search(texts, least, power), strict=True):
            want = brute_runs(t.split(), least, power)
            assert [(r["start"], r["length"], r["period"]) for r in runs] == want
            assert kept == brute_collapsed(t.split(), want)


def test_runs_of_fibonacci_thue_morse_and_one_word():
    a, b = ["a"], ["a", "b"]
    while len(b) < 3000:
        a, b = b, b + a
    morse = ["ab"[bin(i).count("1") % 2] for i in range(4000)]
    for w in (b, morse, ["x"] * 5000, ["x", "y"] * 2500, [*["p", "q", "r"] * 400, "p", *["p", "q", "r"] * 400]):
        runs = periodic_runs._search([" ".join(w)], 6, 4)[0][0]
        assert [(r["start"], r["length"], r["period"]) for r in runs] == brute_runs(w)


def test_runs_stay_within_their_texts(spark):
    df = docs(spark, [(i, "x x x", "en", "s", 1) for i in range(50)] + [(99, "x x x x x x ", "en", "s", 1)])
    got = periodic_runs.periodic_runs(df.coalesce(1), keep=["doc_id", "a.b"])
    assert got.columns == ["doc_id", "a.b", "runs", "collapsed"]
    assert all(r.runs == [] for r in got.collect())


def test_runs_report_equals_brute_force(spark):
    rng = random.Random(4)
    rows = edge_rows() + [(1000 + i, random_text(rng).replace(" ", rng.choice([" ", "\n\t", "  "])), "en", "s", 1) for i in range(400)]
    want = []
    for r in rows:
        w = words_of(r[1])
        if r[0] is not None:
            h = zlib.crc32(str(r[0]).encode())
            g, n = h // 10, len(w)
            if h % 10 == 0 and n:
                a = g % n
                p = 1 + (n - a) // (3 + g % 8)
                w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        runs = brute_runs(w) if len(w) < 3000 else [(0, len(w), 2)]
        best = max(runs, key=lambda x: (x[1], -x[0], -x[2]), default=(None, None, None))
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        want.append((r[0], len(runs), *best, best[0] is not None and 1000 * best[1] // best[2] or None, H(lines), H(brute_collapsed(w, runs))))
    got = periodic_runs.runs_report(docs(spark, rows)).collect()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert periodic_runs.runs_report(docs(spark, [])).collect() == []


def test_runs_time_grows_with_the_text():
    import time

    took = []
    for n in (100_000, 800_000):
        began = time.perf_counter()
        periodic_runs._search([" ".join("ab" for _ in range(n))], 6, 4)
        took.append(time.perf_counter() - began)
    assert took[1] < 16 * took[0] + 1


# --- 10 decontamination: what the fingerprint index is for


def item_block(items, cls=None):
    import pyarrow as pa

    from headwater.llm import decontam
    from headwater.llm.words import Sequences, hashed_words

    words, at = hashed_words(pa.array(items, pa.string()), lower=True)
    seq = Sequences(words)
    import numpy as np

    return (cls or decontam.Items)(list(range(len(items))), [seq.at(np.arange(a, b - 4), 5) for a, b in zip(at[:-1].tolist(), at[1:].tolist())])


def test_fingerprint_index_rules_out_items_and_loses_none():
    import pyarrow as pa

    from headwater.llm import decontam

    class Every(decontam.Items):
        def candidates(self, fp, n, w):
            return (1 << len(self.of_size[n])) - 1

    rng = random.Random(1)
    vocab = [f"w{i}" for i in range(400)]
    stems = [[rng.choice(vocab) for _ in range(12)] for _ in range(40)]
    items = [" ".join(sum((rng.choice(stems) for _ in range(5)), [])) for _ in range(1500)]
    texts = []
    for _ in range(60):
        w = items[rng.randrange(1500)].split()
        for _ in range(rng.randrange(3)):
            w[rng.randrange(60)] = "other"
        texts.append(" ".join([rng.choice(vocab) for _ in range(50)] + w + rng.choice(items).split()[:30]))
    on, off = item_block(items), item_block(items, Every)
    texts = pa.array(texts, pa.string())
    found = on.matches(texts)
    assert found == off.matches(texts) and len(found) > 30
    assert 10 * on.compared < off.compared


def test_item_above_the_broadcast_bound(spark, monkeypatch):
    from headwater.llm import decontam

    monkeypatch.setattr(decontam, "BROADCAST_BYTES", 3 << 19)
    long = " ".join(f"v{i}" for i in range(30_000))
    bench = spark.createDataFrame([(1, long), (2, "one two three four five six seven")], "item_id long, text string")
    small = spark.createDataFrame([(1, "zero one two three four five six seven eight"), (2, None)], "doc_id long, text string")
    large = small.unionByName(spark.createDataFrame([(3, "x " + long.replace("v7 ", "w7 ") + " y")], "doc_id long, text string"))
    pairs = lambda docs: sorted((r.id, r.item_id) for r in decontam.find_leaks(docs, bench, block_bytes=1 << 20).collect())
    assert pairs(small) == [(1, 2)] and pairs(large) == [(1, 2), (3, 1)]
    assert [r.doc_id for r in decontam.drop_leaks(large, bench, block_bytes=1 << 20).collect()] == [2]
    sent = [b.value.ids for b in decontam._broadcasts(small, bench, "text", block_bytes=1 << 20)]
    assert [2] in sent and [1] not in sent
    assert decontam.find_leaks(small, bench.where("item_id = 0")).collect() == []
