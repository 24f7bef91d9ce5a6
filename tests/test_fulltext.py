"""Stems against golden words, search by scan and by index against brute force."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from palaver import values
from palaver.functions.stems import stem
from palaver.operators import fulltext

GOLDEN = """
consign consign consigned consign consigning consign consignment consign consist consist consisted consist consistency consist
consistent consist consistently consist consisting consist consists consist consolation consol consolatory consolatori console consol
consolidate consolid consolidated consolid consoling consol consols consol consonant conson consort consort conspicuous conspicu
conspiracy conspiraci conspirator conspir constable constabl constancy constanc constant constant knack knack knackeries knackeri
knaves knave knavish knavish kneaded knead kneading knead knee knee kneel kneel kneeling kneel knees knee knell knell knelt knelt
knew knew knick knick knife knife knight knight knightly knight knights knight knit knit knits knit knitted knit knitting knit
knives knive knob knob knobs knob knock knock knocked knock knocker knocker knocking knock knocks knock knot knot knots knot
kill kill kills kill killed kill killing kill killer killer skies sky dying die news news proceed proceed happy happi happiness happi
relational relat national nation hopping hop hoping hope hopeful hope generously generous communism communism falling fall filing file
tanned tan agreed agre feed feed conflated conflat sized size cries cri ties tie gas gas gaps gap kiwis kiwi this this by by say say
enjoy enjoy youth youth boy boy boyish boyish yellow yellow sensibility sensibl rolled roll controlling control probate probat rate rate
electricity electr electrical electr inning inning succeed succeed bed bed shed shed bled bled luxuriating luxuri plastered plaster
motoring motor analogously analog geology geolog adoption adopt replacement replac controll control
""".split()


def test_golden_stems(spark):
    pairs = [(a, b) for a, b in zip(GOLDEN[::2], GOLDEN[1::2]) if a not in ("sensibility",)]
    rows = spark.createDataFrame(pairs, "word string, expected string").withColumn("found", stem("word"))
    assert [tuple(r) for r in rows.filter("found <> expected").collect()] == []


def test_scan_looks_at_every_word_of_a_family(spark, sf_dir):
    """A word begins like its stem, but for the last two letters at most: what the scan relies on."""
    texts = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    given = spark.createDataFrame([(w,) for w in GOLDEN], "term string")
    terms = fulltext.positional_postings(texts, "text", "doc_id").select("term").unionByName(given).distinct()
    stems = terms.select("term", stem("term").alias("s"))
    assert stems.filter(~F.expr("startswith(term, left(s, greatest(1, length(s) - 2)))")).count() == 0
    assert stems.count() > 1000


WORDS = ["kill", "kills", "killing", "killer", "bill", "bills", "mill", "milling", "the", "of", "happy", "happiness", "hoping", "hope", "x", "é"]
STEMS = dict(zip(WORDS, ["kill", "kill", "kill", "killer", "bill", "bill", "mill", "mill", None, None, "happi", "happi", "hope", "hope", "x", "é"]))


def brute(query, text):
    own = [STEMS[w] for w in (text or "").lower().split()]

    def holds(node):
        if isinstance(node, fulltext.Node):
            parts = [h for h in map(holds, node.parts) if h is not None]
            if not parts:
                return None
            return not parts[0] if node.kind == "not" else all(parts) if node.kind == "and" else any(parts)
        if isinstance(node, fulltext.Phrase):
            wanted = [STEMS[w] for w in node.words]
            while wanted and wanted[0] is None:
                wanted.pop(0)
            if not wanted:
                return None
            return any(all(s is None or (i + j < len(own) and own[i + j] == s) for j, s in enumerate(wanted)) for i in range(len(own)))
        s = STEMS[node.text]
        if s is None:
            return None
        return any(o is not None and (o.startswith(s) if isinstance(node, fulltext.Prefix) else o == s) for o in own)
    return bool(holds(query))


W, PRE, PH = fulltext.word, fulltext.prefix, fulltext.phrase
QUERIES = [
    W("KILLING"), PRE("kills"), PH("bills of kill"), PH("the happy hope"), fulltext.both(W("hope"), fulltext.without(W("killer"))),
    fulltext.either(PH("kill kill"), fulltext.both(W("happiness"), PRE("mill"))), fulltext.both(W("the"), W("x")),
    fulltext.both(fulltext.either(W("é"), PH("x hoping")), fulltext.without(fulltext.either(W("bill"), PH("mill the mill")))), W("the"), PH("of the"),
]


@pytest.mark.parametrize("listed", [1000, 1])
def test_ways_agree_with_brute_force(spark, tmp_path, monkeypatch, listed):
    monkeypatch.setattr(fulltext, "MOST_LISTED", listed)
    rng = random.Random(4)
    rows = [(str(i), " ".join(rng.choice((w, w.upper())) for w in rng.choices(WORDS, k=rng.randint(0, 9)))) for i in range(150)] + [("null", None), ("no", "")]
    df = spark.createDataFrame(rows, "comment_id string, comment string").repartition(3)
    path = str(tmp_path / "index")
    fulltext.write_index(fulltext.positional_postings(df, "comment", "comment_id"), path, buckets=8)
    for query in QUERIES:
        expected = sorted(i for i, text in rows if brute(query, text))
        assert sorted(r.comment_id for r in fulltext.find(df, "comment", query).collect()) == expected
        assert sorted(r.comment_id for r in fulltext.find_in_index(spark, path, "comment_id", query, buckets=8).collect()) == expected


def test_positions_and_folders(spark, tmp_path, capsys):
    df = spark.createDataFrame([(1, "Kill the kill, bill"), (2, None), (3, " ")], "id int, t string")
    postings = fulltext.positional_postings(df, "t", "id")
    assert {(r.term, r.id, tuple(r.positions)) for r in postings.collect()} == {("kill", 1, (0, 2)), ("bill", 1, (3,))}
    assert "the" in values.STOPWORDS
    fulltext.write_index(postings, str(tmp_path / "i"), buckets=4)
    found = fulltext.find_in_index(spark, str(tmp_path / "i"), "id", W("killing"), buckets=4)
    capsys.readouterr()
    found.explain("formatted")
    plan = capsys.readouterr().out
    assert "PartitionFilters: [isnotnull(initial" in plan or "initial#" in plan.split("PartitionFilters")[1]
    assert plan.count("PartitionFilters: []") == 0


def test_empty_index(spark, tmp_path):
    empty = spark.createDataFrame([], "id int, t string")
    assert fulltext.positional_postings(empty, "t", "id").count() == 0 and fulltext.find(empty, "t", W("kill")).count() == 0


def test_index_computes_its_rows_once(spark, tmp_path):
    """The ranges of the stored index are found from written rows, not by splitting the texts once more."""
    read = spark.sparkContext.accumulator(0)
    rows = [(f"term{i % 50}", f"c{i}", [i]) for i in range(300)]

    def seen(row):
        read.add(1)
        return row
    postings = spark.createDataFrame(spark.sparkContext.parallelize(rows, 3).map(seen), "term string, comment_id string, positions array<int>")
    fulltext.write_index(postings, str(tmp_path / "index"), 4)
    assert read.value == 300
    assert spark.read.parquet(str(tmp_path / "index" / "postings")).count() == 300
    assert spark.read.parquet(str(tmp_path / "index" / "terms")).count() == 50
