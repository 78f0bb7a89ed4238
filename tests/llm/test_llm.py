"""Operators of the llm subpackage on small cases, and against plain versions."""

import base64
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from conftest import DATA, rows
from pyspark.sql import functions as F

from signalframe.llm import catalog, mail, subjects
from signalframe.llm.bpe import encoder
from signalframe.llm.mixing import mix, shares
from signalframe.llm.survivors import align, consensus, distance, filled, json_text, representative, surviving_fields
from signalframe.llm.tokens import encode_texts, with_token_counts

# tokens


@pytest.fixture(scope="module")
def plain():
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


PARTS = ["'s", "'re", "'x", " ", "  ", "\n", "\r\n", "\t", "\x1c", "\x00", "\x85", ".", "--", "==", "AbCd", "zQ1", "0000", "é", "漢字", "👩‍🔬", "<|endoftext|>", "word", " the", "ing", "aaaa", "﻿", "٣"]


def test_encoding_equals_the_plain_merges(plain):
    rnd, e = random.Random(1), encoder()
    for n in range(3000):
        text = "".join(rnd.choice(PARTS) for _ in range(rnd.randint(0, 25)))
        assert e.encode(text).tolist() == plain(text), (n, text)
        assert e.count(text) == len(plain(text))


def test_random_letters_need_backtracking(plain):
    rnd, e = random.Random(2), encoder()
    for _ in range(500):
        text = "".join(rnd.choice("ABCDEFGHabcdefghijklmnopqrstuvwxyz+/") for _ in range(200))
        assert e.encode(text).tolist() == plain(text)


def test_long_and_odd_texts(plain):
    e = encoder()
    for text in ("a" * 200_000, " " * 100_000, "ab" * 50_000, "\n" * 10_000 + "x", "ä" * 20_000):
        assert e.encode(text).tolist() == plain(text)


def test_encode_texts(spark, plain):
    texts = [(1, "hello world", 9), (2, "", 9), (3, None, 9), (3, "hello world", 9), (None, "x", 9), (4, "  ", 9)]
    df = spark.createDataFrame(texts, "doc_id bigint, text string, ids int")
    got = Counter((r[0], tuple(r[1])) for r in encode_texts(df, "doc_id", "text").collect())
    assert got == Counter((k, tuple(plain(t or ""))) for k, t, _ in texts)
    assert {r[0]: r[1] for r in with_token_counts(df.filter("doc_id = 1"), "doc_id", "text").collect()} == {1: 2}
    assert encode_texts(df.limit(0), "doc_id", "text").count() == 0


def test_corpus_round_trip(spark, plain):
    docs = {r[0]: r[1] for r in spark.read.parquet(f"{DATA}/sf0.001/documents.parquet").select("doc_id", "text").collect()}
    ids = {r[0]: r[1] for r in catalog.queries()["p8_ids"](spark, f"{DATA}/sf0.001").collect()}
    assert ids == {k: plain(t or "") for k, t in docs.items()}


# mixing


def sized(spark, data):
    return spark.createDataFrame(data, "doc_id bigint, source string, n_tokens bigint")


def test_shares_are_met(spark):
    rnd = random.Random(4)
    data = [(i, rnd.choice(["big", "Big ", "BIG", "mid"]) if i % 50 else "small", rnd.randint(1, 100)) for i in range(4000)] + [(9000, None, 5), (9001, "other", 5), (9002, "big", 0)]
    targets = spark.createDataFrame([("big", 0.5, 1), ("mid", 0.3, 2), ("small", 0.1, 3), ("none", 0.1, 4)], "source string, target_share double, max_repeats int")
    s = sized(spark, data).cache()
    report = {r["source"]: r.asDict() for r in shares(s, targets, range_bits=4).collect()}
    assert report["none"]["tokens"] == 0 and set(report) == {"big", "mid", "small", "none"}
    for name, r in report.items():
        assert abs(r["reached_share"] - r["scaled_share"]) < 0.01 and r["most_uses"] <= r["max_repeats"], name
        assert abs(r["tokens"] - r["budget_tokens"]) <= 100
    used = {r["doc_id"]: r["uses"] for r in mix(s, targets, range_bits=4).collect()}
    assert len(used) == sum(r["documents"] for r in report.values()) and not {9000, 9001, 9002} & set(used)
    assert used == {r["doc_id"]: r["uses"] for r in mix(s.repartition(7), targets, range_bits=9).collect()}  # ranges don't matter
    assert max(report.values(), key=lambda r: r["tokens"] / max(1, r["available_tokens"] * r["max_repeats"]))["tokens"] > 0


def test_mixing_nothing(spark):
    targets = spark.createDataFrame([("a", 1.0, 1), ("b", None, None)], "source string, target_share double, max_repeats int")
    assert mix(sized(spark, []), targets).count() == 0
    assert [r["tokens"] for r in shares(sized(spark, []), targets).collect()] == [0, 0]
    assert mix(sized(spark, [(1, "a", 5)]), targets.limit(0)).count() == 0


# survivors


def test_consensus_votes_by_column():
    split = str.split
    assert consensus([split("a b c"), split("a x c"), split("a b c d")], [1, 1, 1]) == split("a b c")
    assert consensus([split("a b"), split("x y"), split("x y")], [4, 2, 1]) == split("a b")
    assert representative(["Europe/Berlin", "Europe/Bern", "Europe/Berlin"], [1, 1, 1]) == 0
    assert representative(["1 2 3", "1 2 4", "1 9 4"], [1, 1, 1]) == 1
    assert representative(["x " * 2000, "x " * 1999 + "y"], [2, 1]) == 0  # long values
    assert representative(["", "a"], [2, 1]) == 0


def test_heavier_than_the_rest_decides():
    rnd = random.Random(6)
    for _ in range(300):
        values = [" ".join(rnd.choice("abcd") for _ in range(rnd.randint(1, 5))) for _ in range(rnd.randint(1, 7))]
        assert values[representative(values, [1 << (len(values) - 1 - i) for i in range(len(values))])] == values[0]


def test_filled(spark):
    df = spark.createDataFrame([(x,) for x in (None, "", "  ", "-", "N/A", "0", "0.0", "00:00", "0000-00-00", "unknown", " 7 ", "Europe/Berlin")], "v string")
    assert [r[0] for r in df.select(filled(F.col("v"))).collect()] == [None] * 10 + ["7", "Europe/Berlin"]
    j = spark.createDataFrame([('{"a": 5}',), ('{"a": "x"}',), ('{"a": 5',), ("[]",), (None,), ('{"a": null}',), ('{ "b" : {"a": 1} }',)], "v string")
    assert [r[0] for r in j.select(json_text(F.col("v"), "a")).collect()] == ["5", "x", None, None, None, None, None]


def test_surviving_fields(spark):
    data = [("g", f"c{i}", i % 5, i, "ACTIVE", f"v{i}" if i % 3 else None) for i in range(200)] + [("one", "c", 1, 1, "ACTIVE", "v"), ("two", "d", 9, 1, "MISSING", "v"), ("two", "e", 1, 1, "ACTIVE", None), (None, "x", 1, 1, "ACTIVE", "v"), ("tie", "b", 1, 1, "ACTIVE", "v"), ("tie", "a", 1, 1, "ACTIVE", "w")]
    df = spark.createDataFrame(data, "g string, c string, trust int, at int, status string, v string")
    got = rows(surviving_fields(df, {"v": F.col("v")}, group="g", copy="c", order=[F.col("trust"), F.col("at")], active=F.col("status") == "ACTIVE"))
    best = max((r for r in data if r[0] == "g" and r[5]), key=lambda r: (r[2], r[3]))
    assert got == [("g", "v", best[1]), ("tie", "v", "a")]


def test_alignment_keeps_order_and_all_tokens():
    rnd = random.Random(8)
    for _ in range(1000):
        a, b = ([rnd.choice("abcdef") for _ in range(rnd.randint(0, 9))] for _ in "ab")
        pairs = align(a, b)
        assert [i for i, _ in pairs if i is not None] == list(range(len(a))) and [j for _, j in pairs if j is not None] == list(range(len(b)))
        assert (distance(a, b) == 0) == (a == b) and distance(a, b) <= max(len(a), len(b)) + min(len(a), len(b))
    assert distance("the quick brown fox".split(), "the brown fox".split()) == 1
    long = [str(i) for i in range(200_000)]
    assert distance(long, long[:5] + long[6:]) == 1


WEIGHTED = "g string, c string, trust int, at int, status string, v string, votes int"


def test_votes_may_differ_from_the_first_copy(spark):
    """Planted: the copy that ranks first is alone with its spelling; the others agree token by token."""
    data = [("g", "first", 9, 9, "ACTIVE", "2025-06-15 12:00", 3), ("g", "b", 5, 5, "ACTIVE", "2025-06-16 12:00", 2), ("g", "c", 4, 5, "ACTIVE", "2025-06-16 12:00", 2), ("g", "d", 3, 5, "ACTIVE", "2025-06-16 13:00", 1), ("g", "off", 8, 8, "TOMBSTONE", "2025-06-15 12:00", 99)]
    df = spark.createDataFrame(data, WEIGHTED)
    args = {"group": "g", "copy": "c", "order": [F.col("trust"), F.col("at")], "active": F.col("status") == "ACTIVE"}
    assert rows(surviving_fields(df, {"v": F.col("v")}, **args)) == [("g", "v", "first")]
    assert rows(surviving_fields(df, {"v": F.col("v")}, **args, weight=F.col("votes"))) == [("g", "v", "b")]


def test_votes_equal_those_of_whole_groups(spark):
    rnd = random.Random(9)
    data = [(f"g{g}", f"c{g}-{i}", rnd.randint(0, 2), rnd.randint(0, 5), rnd.choice(["ACTIVE", "ACTIVE", "MISSING"]), rnd.choice([None, " ".join(rnd.choice("abcd") for _ in range(rnd.randint(1, 5)))]), rnd.choice([None, -1, 0, 1, 2, 5])) for g in range(60) for i in range(rnd.choice([1, 2, 3, 8, 40]))]
    want = set()
    for g in {r[0] for r in data}:
        of = [r for r in data if r[0] == g]
        live = sorted((r for r in of if r[4] == "ACTIVE" and r[5]), key=lambda r: (-r[2], -r[3], r[1]))
        if len(of) > 1 and live:
            votes: dict = {}
            for r in live:
                votes[r[5]] = votes.get(r[5], 0) + max(0, r[6] or 0)
            best = list(votes)[representative(list(votes), list(votes.values()))]
            want.add((g, "v", next(r[1] for r in live if r[5] == best)))
    df = spark.createDataFrame(data, WEIGHTED)
    got = surviving_fields(df, {"v": F.col("v")}, group="g", copy="c", order=[F.col("trust"), F.col("at")], active=F.col("status") == "ACTIVE", weight=F.col("votes"))
    assert set(rows(got)) == want
    first = {(x, f, c) for x, f, c in rows(surviving_fields(df, {"v": F.col("v")}, group="g", copy="c", order=[F.col("trust"), F.col("at")], active=F.col("status") == "ACTIVE"))}
    assert len(first) == len(want) and len(first - want) > 5


def test_consensus_of_the_records_is_not_always_the_first(spark):
    q = catalog.queries()
    by_votes, by_rank = (set(rows(q[n](spark, f"{DATA}/sf0.001"))) for n in ("p3_consensus", "p3_found"))
    assert {r[:2] for r in by_votes} == {r[:2] for r in by_rank} and by_votes - by_rank


def test_p3_equals_sql(spark):
    import duckdb

    con = duckdb.connect()
    con.execute("set timezone='UTC'")
    for t in ("physical_records", "source_databases"):
        con.execute(f"create view {t} as select * from '{DATA}/sf0.001/{t}.parquet'")
    df = catalog.queries()["p3_found"](spark, f"{DATA}/sf0.001").select("logical_record_id", "field_name", "physical_record_id")
    assert rows(df) == sorted(con.execute(catalog.oracle_sql()["p3_found"]).fetchall())


# mail

BODY = "Hello,\n\nThe plan works. It is done!\n\nOn Mon, A B wrote:\n> old words here.\n>> older.\n\nMy answer is no.\n\n(By the way: nothing.)\n\n-- \nName, Title\n"


@pytest.mark.parametrize("make", [
    lambda b: "Subject: x\n\n" + b,
    lambda b: "Subject: x\r\n\r\n" + b.replace("\n", "\r\n"),
    lambda b: "Subject: x\nContent-Transfer-Encoding: base64\n\n" + base64.encodebytes(b.encode()).decode(),
    lambda b: "Subject: x\nContent-Type: multipart/mixed; boundary=\"q\"\n\n--q\nContent-Type: text/plain\n\n" + b + "\n--q\nContent-Disposition: attachment; filename=a\n\nAttached words. More.\n--q--\n",
    lambda b: "Subject: x\nContent-Type: multipart/mixed; boundary=\"q\"\n\n--q\nContent-Type: text/plain\n\n" + b,
    lambda b: "Subject: x\nContent-Type: text/html\n\n<html><style>p{}</style><p>Hello,</p><p>The plan works. It is done!</p><blockquote>old words here.</blockquote><p>My answer is no.</p></html>",
])
def test_own_sentences(make):
    _, body = mail.message_text(make(BODY))
    assert [s for s in mail.own_sentences(body) if s not in ("Hello,", "(By the way: nothing.)")] == ["The plan works.", "It is done!", "My answer is no."]


def test_odd_messages():
    for text in (None, "", "   \n", "no headers. At all.", "Subject: x", "Content-Type: multipart/mixed\n\n", "Content-Type: multipart/mixed; boundary=a\n\n--a\n" * 50, "Content-Transfer-Encoding: base64\n\n====", "Content-Type: text/plain; charset=nonsense\nContent-Transfer-Encoding: quoted-printable\n\n=FF=E4."):
        assert isinstance(subjects.read_message(text)[0], list)
    assert mail.repair("schÃ¶n") == "schön"


@pytest.mark.parametrize("depth", [1, 7, 400])
def test_nested_multiparts(depth):
    text = "Content-Type: text/plain\n\nDeep down. It is read."
    for i in range(depth):
        text = f'Content-Type: multipart/{("mixed", "alternative")[i % 2]}; boundary="b{i}x"\n\n--b{i}x\n{text}\n--b{i}x--\n'
    assert mail.own_sentences(mail.message_text(text)[1]) == ["Deep down.", "It is read."]


def test_alternatives_and_attachments():
    part = lambda kind, text, more="": f"--q\nContent-Type: {kind}\n{more}\n{text}\n"
    both = part("text/html", "<p>Marked up.</p>") + part("text/plain", "Plain.")
    read = lambda kind, parts: mail.message_text(f'Content-Type: multipart/{kind}; boundary="q"\n\n{parts}--q--\n')[1].split()
    assert read("alternative", both) == ["Plain."] and read("mixed", both) == ["Marked", "up.", "Plain."]
    assert read("alternative", part("text/html", "<p>Marked up.</p>") + part("text/plain", " ")) == ["Marked", "up."]
    assert read("mixed", both + part("text/plain", "Hidden.", "Content-Disposition: attachment\n")) == ["Marked", "up.", "Plain."]


@pytest.mark.parametrize("text", [
    "The court gave new advice on the contract. Our lawyer shared the advice with the board.",
    "The firewall stopped the malware. No viruses were found in the build.",
    "Liability was settled. The judge called it confidential (so did counsel).",
    "(They met in court. The verdict came late.)",
])
def test_no_word_makes_a_paragraph_a_notice(text):
    assert len(mail.own_sentences(text)) == 2


def test_sentences_need_no_full_stop():
    assert mail.own_sentences("They play the final on Sunday\n\nThe goalkeeper is fit. The coach agrees") == ["They play the final on Sunday", "The goalkeeper is fit.", "The coach agrees"]


# subjects


def corpus(n, seed):
    rnd = random.Random(seed)
    words = {s: [f"{s}{i}" for i in range(12)] for s in ("alpha", "beta", "gamma")}
    out = []
    for i in range(n):
        mine = rnd.sample(sorted(words), rnd.choice([0, 1, 1, 2]))
        lines = [f"The {rnd.choice(words[s])} and the {rnd.choice(words[s])} are fine." for s in mine for _ in range(rnd.randint(2, 4))] + ["Thanks for the note.", "See you soon."]
        if len(mine) < 3:  # one mention in passing
            other = rnd.choice([s for s in words if s not in mine])
            lines.append(f"I saw the {rnd.choice(words[other])} once.")
        rnd.shuffle(lines)
        out.append((i, "Subject: x\n\n" + " ".join(lines), rnd.choice(["A", " a", None]), mine))
    return out


def test_subjects_of_held_out_messages(spark):
    data = corpus(700, 5)
    docs = spark.createDataFrame([(i, t, s) for i, t, s, _ in data] + [(9001, None, None), (9002, "", None), (9003, "x" * 100_000, None)], "doc_id bigint, text string, source string")
    labels = spark.createDataFrame([(i, s.upper() + " ") for i, _, _, m in data[:400] for s in m[:1] + [x for x in m[1:] if i % 3]] + [(1, "nonsense"), (None, "alpha")], "doc_id bigint, subject string")
    names = spark.createDataFrame([("alpha",), ("beta",), ("gamma",)], "subject string")
    model = subjects.learn(docs, labels, names)
    found = {tuple(r) for r in subjects.subject_areas(docs, model).collect()}
    truth = {(i, s) for i, _, _, m in data[400:] for s in m}
    held = {x for x in found if x[0] >= 400}
    assert len(held & truth) / len(truth) > 0.93 and len(held & truth) / max(1, len(held)) > 0.93
    assert subjects.subject_areas(docs.limit(0), model).count() == 0


def test_chain_equals_all_combinations():
    """With room in the beam the decision is the most probable of all combinations, with the factors of the subjects left out."""
    rnd = np.random.default_rng(3)
    k = 5
    for _ in range(60):
        m = subjects.SubjectModel(list("abcde"), [2, 0, 4, 1, 3], subjects.TermModel({}, np.zeros((0, k)), np.zeros(k)), {"\0": rnd.normal(size=k)}, [rnd.normal(size=14 + at) * 2 for at in range(k)], np.array([0.9, 0.7]), np.full(k, 0.5))
        scores, structure = rnd.random((5, k)), [0.0, 1.0, 0.0, 1.0]
        enough = (scores > 0.5).sum(0) >= 2
        ev, common = subjects.evidence(scores, m.cut), subjects.shared_features(5, structure)
        rate = np.where(ev[:, 6] >= ev[:, 6].max(), *m.labelled_rate)
        best = None
        for mask in range(1 << k):
            y, logp = [mask >> j & 1 for j in range(k)], 0.0
            for at, j in enumerate(m.order):
                x = np.concatenate([common, ev[j], m.sources["\0"][j : j + 1], [y[i] for i in m.order[:at]]])
                p = min(0.999, max(0.001, float(1 / (1 + np.exp(-m.chain[at] @ x))) / rate[j]))
                logp += np.log(p if y[j] else 1 - p)
            if not any(y[j] and not enough[j] for j in range(k)) and (best is None or logp > best[0]):
                best = (logp, {m.subjects[j] for j in range(k) if y[j]})
        assert set(m.decide(scores, structure, "x")) == (best[1] if enough.any() else set())


def test_every_source_has_its_odds():
    labels = np.array([[1.0, 0.0]] * 50 + [[0.0, 1.0]] * 50)
    odds = subjects.source_odds([f"s{i % 50}" for i in range(50)] + ["other"] * 50, labels)
    assert len(odds) == 52 and odds["other"][0] < odds["\0"][0] < odds["s49"][0]


def test_learning_from_nothing(spark):
    docs = spark.createDataFrame([(1, "Subject: x\n\nOne. Two.", "a")], "doc_id bigint, text string, source string")
    labels = spark.createDataFrame([], "doc_id bigint, subject string")
    model = subjects.learn(docs, labels, spark.createDataFrame([("alpha",)], "subject string"))
    assert subjects.subject_areas(docs, model).count() == 0


def test_logistic_fit():
    rnd = np.random.default_rng(1)
    x = np.hstack([np.ones((2000, 1)), rnd.normal(size=(2000, 2))])
    y = (rnd.random(2000) < 1 / (1 + np.exp(-(x @ np.array([-1.0, 2.0, 0.0]))))).astype(float)
    assert np.allclose(subjects.fit_logistic(x, y), [-1, 2, 0], atol=0.25)


@pytest.mark.parametrize("name", ["p3_consensus", "p9_mix", "p9_shares", "p10_found"])
def test_queries_run(spark, name):
    df = catalog.queries()[name](spark, f"{DATA}/sf0.001").cache()
    assert df.count() == df.distinct().count() > 0
