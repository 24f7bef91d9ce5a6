"""Fill-in-the-middle, licence scans and clusters against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from palaver.llm import centroids, license_scan, piece_table, queries

from .conftest import prose


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


# fill-in-the-middle

def brute_fim(key, text):
    text = text or ""
    draws = [int(sha(f"1:{'null' if key is None else key}".encode())[i:i + 8], 16) for i in (0, 8, 16, 24)]
    n = len(text)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or draws[2] % 100 >= 90:
        return n, "plain", None, None, text
    low, high = sorted(d % (n + 1) for d in draws[:2])
    prefix, middle, suffix = text[:low], text[low:high], text[high:]
    if draws[3] % 100 < 20:
        return n, "spm", low, high - low, f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", low, high - low, f"<P>{prefix}<S>{suffix}<M>{middle}"


def test_pieces_of_edge_rows(edge_docs, edge_rows, no_docs):
    out = piece_table.fill_in_middle(edge_docs)
    rows = piece_table.restore(out).collect()
    assert Counter((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in rows) == Counter(
        (d, *brute_fim(d, t)) for d, t, *_ in edge_rows)
    for r in rows:
        assert r.restored == (r.text or "") and r.output_sha256 == sha(r.output.encode())
        assert r.restored_sha256 == sha((r.text or "").encode()) and r["row"] == "own row"
    assert piece_table.fill_in_middle(no_docs).count() == 0
    assert piece_table.restore(piece_table.fill_in_middle(no_docs)).count() == 0


def test_pieces_of_marks_and_wide_characters(spark, monkeypatch):
    monkeypatch.setattr(piece_table, "SLICE_BYTES", 5000)
    monkeypatch.setattr(piece_table, "BLOCK", 7)
    choose = random.Random(5)
    alphabet = ["a", "é", "日", "🎉", "<", ">", "P", "S", "M", "\0", "\n", " "]
    texts = ["<P>", "a<S>b", "<M", "<P<S", ">", "<", "é", "🎉", "x" * 9000, "日" * 4000] + [
        "".join(choose.choice(alphabet) for _ in range(choose.randrange(60))) for _ in range(600)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    rows = piece_table.restore(piece_table.fill_in_middle(docs)).collect()
    assert {(r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in rows} == {(i, *brute_fim(i, t)) for i, t in enumerate(texts)}
    assert all(r.restored == r.text and r.restored_sha256 == sha(r.text.encode()) for r in rows)
    assert {r.form for r in rows} == {"plain", "psm", "spm"}


def test_restore_of_missing_values(spark):
    rows = spark.createDataFrame([(1, None, "psm"), (2, "x", None), (3, "x", "plain"), (4, "<P>a<S><M>", "psm")], "id int, output string, form string")
    assert [r.restored for r in piece_table.restore(rows).orderBy("id").collect()] == [None, None, "x", "a"]


def test_cuts_and_permutations_are_undone():
    data, marks = memoryview(b"abcdefgh"), memoryview(piece_table.SENTINELS)
    whole = piece_table.PieceTable((data, marks), [(piece_table.TEXT, 0, 8)])
    for places in ([0, 0], [0, 8], [3, 3], [2, 5], [8, 8]):
        parts = whole.cut(places)
        assert len(parts.pieces) == 3 and b"".join(parts.stream()) == b"abcdefgh"
        for form in ("psm", "spm"):
            output = b"".join(parts.with_sentinels().arranged(piece_table.ARRANGED[form]).stream())
            assert b"".join(piece_table.restored(output, form).stream()) == b"abcdefgh"


# licences

def brute_licences(text, templates=license_scan.TEMPLATES, phrases=license_scan.PHRASES, contained=license_scan.CONTAINED):
    own = license_scan.plain_words(text or "")
    assert own == re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    places, base = [], set()
    for phrase, label in phrases.items():
        p = phrase.split()
        at = [i for i in range(len(own) - len(p) + 1) if own[i:i + len(p)] == p]
        places += at
        base |= {label} if at else set()
    sets = [(label, set(license_scan.plain_words(t))) for label, t in templates]
    stride = max(len(license_scan.plain_words(t)) for _, t in templates)
    blocks = []
    for j in range(max(1, math.ceil(len(own) / stride) - 1)):
        block = set(own[j * stride:(j + 2) * stride])
        for label, s in sets:
            if len(s & block) >= max(1, math.ceil(len(s) * contained - 1e-9)):
                blocks.append((j * stride, min((j + 2) * stride, len(own)), label, len(s & block) / len(s)))
    score = 1.0 if base else max([b[3] for b in blocks], default=0.0)
    row = (len(own), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)),
           ",".join(sorted(base | {b[2] for b in blocks})), score)
    return row, blocks


def license_texts():
    choose = random.Random(8)
    filler = "the of a to and in public general software free terms with source form version work is this under license copy any".split()
    texts = ["MIT License", "mit-license, MIT LICENSE; mit license", "gnu general public license gnu general public license",
             "GNU\nGeneral (Public) License", "xcc by", "cc by-nc 4.0 cc by", "É mit license é", "a" * 100_000 + " apache license"]
    for i in range(400):
        words = [choose.choice(filler) if choose.random() < 0.5 else "w" + str(choose.randrange(300)) for _ in range(choose.randrange(160))]
        _, notice = choose.choice(license_scan.TEMPLATES)
        notice = license_scan.plain_words(notice)
        for _ in range(choose.randrange(5)):
            notice[choose.randrange(len(notice))] = "changed"
        at = choose.randrange(len(words) + 1)
        texts.append(choose.choice([" ", "\n", " - "]).join(words[:at] + notice + words[at:]))
    return texts


def test_licences_of_many_texts(spark):
    texts = license_texts()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    rows = {r[0]: tuple(r)[1:] for r in license_scan.scan(docs, keep=["doc_id"]).collect()}
    blocks = Counter(map(tuple, license_scan.license_blocks(docs, keep=["doc_id"]).collect()))
    expected = [brute_licences(t) for t in texts]
    assert rows == {i: row for i, (row, _) in enumerate(expected)}
    assert blocks == Counter((i, *b) for i, (_, found) in enumerate(expected) for b in found)
    assert sum(blocks.values()) > 100 and sum(not found for _, found in expected) > 50


@pytest.mark.parametrize("contained", [0.3, 0.5, 1.0])
def test_licences_of_other_thresholds(spark, contained):
    templates = [("one", "a b c d e f"), ("two", "c d g h"), ("three", "a a a"), ("four", "k l m n o p q r s t")]
    choose = random.Random(3)
    texts = [" ".join(choose.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(choose.randrange(40))) for _ in range(200)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = Counter(map(tuple, license_scan.license_blocks(docs, keep=["doc_id"], templates=templates, contained=contained).collect()))
    assert found == Counter((i, *b) for i, t in enumerate(texts) for b in brute_licences(t, templates, {"x": "x"}, contained)[1])


def test_overlapping_phrases_all_count(spark):
    docs = spark.createDataFrame([(1, "a b a b a, c")], "doc_id long, text string")
    r = license_scan.scan(docs, phrases={"a b a": "aba", "c": "c"}, templates=[]).first()
    assert (r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, r.score) == (3, 0, 5, "aba,c", "aba,c", 1.0)


def test_licences_of_edge_rows(edge_docs, edge_rows, no_docs):
    out = license_scan.scan(edge_docs)
    rows = out.collect()
    columns = license_scan.RESULTS
    assert Counter((r.doc_id, *[r[c] for c in columns]) for r in rows) == Counter((d, *brute_licences(t)[0]) for d, t, *_ in edge_rows)
    assert all(r["row"] == "own row" and r["_text"] == "own _text" for r in rows)
    assert license_scan.scan(no_docs).count() == 0 and license_scan.license_blocks(no_docs).count() == 0


def test_licence_plan_is_native_and_without_shuffle(edge_docs):
    plan = license_scan.scan(edge_docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|Exchange", plan)


# clusters

def brute_clusters(rows, k=8, rounds=10):
    kept = [(key, [math.floor(1024 * x) for x in v]) for key, v in rows
            if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]

    def distance(a, b):
        return sum((x - y) ** 2 for x, y in zip(a, b))

    centres = [v for _, v in sorted(kept, key=lambda r: sha(f"3:{'null' if r[0] is None else r[0]}".encode()))[:k]]

    def nearest(v):
        return min(range(len(centres)), key=lambda c: (distance(v, centres[c]), c))

    for _ in range(rounds):
        own = [nearest(v) for _, v in kept]
        for c in range(len(centres)):
            members = [v for (_, v), o in zip(kept, own) if o == c]
            if members:
                centres[c] = [sum(x) // len(members) for x in zip(*members)]
    own = [nearest(v) for _, v in kept]
    far = [distance(v, centres[c]) for (_, v), c in zip(kept, own)]
    totals = Counter()
    for c, d in zip(own, far):
        totals[c] += d
    names = [sha(",".join(map(str, c)).encode()) for c in centres]
    return Counter((key, c, d, totals[c], sum(far), names[c]) for (key, _), c, d in zip(kept, own, far))


def found_clusters(df):
    return Counter(map(tuple, centroids.with_inertia(*centroids.cluster(df)).collect()))


VECTORS = "vec_id long, embedding array<float>, cluster string, distance int"


def frame(spark, rows):
    return spark.createDataFrame([(key, v, "own", 1) for key, v in rows], VECTORS)


def vectors(seed, n, scale=0.2):
    draw = np.random.default_rng(seed)
    centres = draw.normal(0, scale, (5, 64))
    return [[float(x) for x in (centres[i % 5] + draw.normal(0, scale / 3, 64)).astype(np.float32)] for i in range(n)]


def test_clusters_of_edge_rows(spark):
    good = vectors(1, 60)
    rows = list(enumerate(good)) + [(100, None), (101, good[0][:63]), (102, good[0] + [0.0]), (103, [None] + good[0][1:]), (104, []),
                                    (105, [float("nan")] + good[0][1:]), (106, [float("-inf")] + good[0][1:]), (None, good[3]),
                                    (107, good[7]), (108, good[7]), (7, good[7]), (7, good[7]), (200, [0.0] * 64)]
    assert found_clusters(frame(spark, rows)) == brute_clusters(rows)


@pytest.mark.parametrize("n", [0, 1, 5])
def test_clusters_of_few_vectors(spark, n):
    rows = list(enumerate(vectors(2, n)))
    assert found_clusters(frame(spark, rows)) == brute_clusters(rows)


def test_ties_and_empty_clusters(spark):
    rows = [(i, [1.0 if i % 3 else 0.0] * 64) for i in range(30)]  # two points: six centroids stay empty
    assert found_clusters(frame(spark, rows)) == brute_clusters(rows)


def test_clusters_of_large_components(spark):
    rows = list(enumerate(vectors(3, 40, scale=30_000.0)))
    assert found_clusters(frame(spark, rows)) == brute_clusters(rows)
    with pytest.raises(Exception, match="64 bits"):
        centroids.cluster(frame(spark, rows + [(99, [1e30] * 64)]))


def test_transform_is_exact_and_search_drops_only_worse_ones():
    draw = np.random.default_rng(4)
    points, centres = draw.integers(-2000, 2000, (500, 64)), draw.integers(-2000, 2000, (12, 64))
    points[:, 1:] //= 20  # most of the difference lies in the first components
    centres[5], centres[9] = centres[2], points[0]
    own = centroids.coefficients(points)
    assert (centroids.vectors(own.astype(object)) == points).all()
    assert (np.abs(np.diff(np.sign(centroids.hadamard(np.eye(64, dtype=np.int64))[:, centroids.ORDER].T), axis=1)).sum(axis=1) == 2 * np.arange(64)).all()
    best, total, met = centroids.search(own, centroids.coefficients(centres))
    exact = ((points[:, None] - centres[None]) ** 2).sum(axis=2)
    assert (best == exact.argmin(axis=1)).all() and (total == 64 * exact.min(axis=1)).all() and 5 not in best
    assert met < len(points) * (len(centres) + 1) * 64


def test_clusters_do_not_depend_on_partitions(spark):
    rows = list(enumerate(vectors(6, 200)))
    assert found_clusters(frame(spark, rows).repartition(1)) == found_clusters(frame(spark, rows).repartition(7)) == brute_clusters(rows)


def test_new_queries_equal_their_sql(spark, duck, sf_dir):
    from palaver.llm import checks

    for name in ("op11_piece_table", "op12_license_join", "op13_hadamard_centroids"):
        found = queries.QUERIES[name](spark, sf_dir)
        expected = duck.execute(checks.SQL[name])
        columns = [c[0] for c in expected.description]
        assert Counter(map(tuple, found.select(columns).collect())) == Counter(expected.fetchall())
