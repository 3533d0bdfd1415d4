"""Quality rules, ranked search and conversation repair against plain Python, with nulls, ties, repeats and clashing columns."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter
from functools import lru_cache

import pytest
from pyspark.sql import functions as F

from opsflow.llm import conversation_repair, quality_rules, ranked_search

DOCS = "doc_id long, text string, lang string, n_words long, stratum string, iid long, rank int, score long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def prose(rng, n, variety=300):
    return " ".join(rng.choice(["stone", "river", "Ñandú", "été"]) + str(rng.randrange(variety)) for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(11)
    out = [(i, prose(rng, rng.randrange(1, 200)), "en") for i in range(60)]
    out += [(60, None, "en"), (61, "", None), (62, " \n\t\n", "fr"), (63, "a a a a", "fr"), (64, "one two three one two three four", "fr"),
            (65, "Same line\nSame line\nother\n \n \nSame line ", "de"), (66, prose(rng, 3000, 4), "en"), (67, "# * $ % & | < > ##", None),
            (68, "x" * 5000, "en"), (69, prose(rng, 80) + " ###" * 70, "en"), (64, "one two three one two three four", "fr"),
            (None, prose(rng, 70) + "\x00nul", None), (70, "a b\x0bc d\x0ce a b\rc d", "en"), (71, "\n".join(["dull line here"] * 30), "en")]
    return out


@pytest.fixture(scope="module")
def docs(spark, texts):
    return spark.createDataFrame([(i, t, la, 1, "x", 2, 3, 4) for i, t, la in texts], DOCS).repartition(3)


def counts(text):
    words = WORD.findall(text or "")
    grams = list(zip(words, words[1:], words[2:]))
    often = Counter(grams)
    covered = {i + d for i, g in enumerate(grams) if often[g] > 1 for d in range(3)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered), len(lines))


def test_quality_counts(docs, texts):
    got = quality_rules.signals(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines").collect()
    assert Counter(tuple(r) for r in got) == Counter((i, *counts(t)) for i, t, _ in texts)


def test_binomial_p_is_exact(spark):
    rows = [(n, k) for n in (1, 7, 60, 400) for k in range(0, n + 1, max(1, n // 9))] + [(5000, 0), (5000, 30), (200_000, 900)]
    got = spark.createDataFrame(rows, "n long, k long").withColumn("p", quality_rules.binomial_p(F.col("n"), F.col("k"), 0.01)).collect()
    for n, k, p in got:
        if k >= n * 0.01:
            assert p == 1.0
        else:
            terms = (math.exp(math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(0.01) + (n - i) * math.log(0.99))
                     for i in range(k + 1))
            assert p == pytest.approx(math.fsum(terms), rel=1e-7)


def test_cutoffs_bound_false_rejection_per_stratum(spark):
    """Good texts of one stratum hold many symbols: its rule stays lenient there, and a small stratum gets none."""
    rng = random.Random(3)
    rows, labels = [], []
    for i in range(2600):
        lang = ("a", "b", "b", "a", None)[i % 5] if i < 2500 else "tiny"
        good = i % 4 != 0
        symbols = {"a": 0, "b": 25, None: 0, "tiny": 0}[lang] if good else 90
        rows.append((i, prose(rng, 60, 10_000) + "#" * symbols, lang))
        labels.append((i, int(good), 0))
    labels += [(1, 0, 0), (9_999, 1, 0), (None, 1, 0)]  # contradicting, without a document, without an id
    got = quality_rules.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string"),
                              spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), max_false_rejection=0.08).collect()
    cuts = {r.stratum: r.cut_symbols for r in got}
    # Shares of 0 (stratum a), 25 / 60 = 416 (b) and 1500 thousandths (bad texts).
    assert cuts == {"=a": 100, "=b": 500, "null": 100, "=tiny": None}
    for r in got:
        assert not r.base_failed and r.kept == (r.doc_id % 4 != 0 or r.stratum == "=tiny")
        assert ("symbols" in r.failed) is (not r.kept)  # the symbols also make one word long


def test_quality_without_labels_or_rows(spark, docs, texts):
    none = spark.createDataFrame([], "doc_id long, quality int")
    got = quality_rules.judge(docs, none).collect()
    assert len(got) == len(texts)
    for r in got:
        assert r.kept is (not r.base_failed) and r.base_failed == (r.n_words < 50 or 2 * r.n_repeat_words > r.n_words)
    assert {r.doc_id for r in got if not r.base_failed} >= {69, None} and 71 not in {r.doc_id for r in got if r.kept}
    assert quality_rules.judge(docs.limit(0), none).collect() == []


TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms_of(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def ranked(texts, query, k):
    held = [(i, Counter(terms_of(t)), len(terms_of(t))) for i, t, _ in texts]
    held = [x for x in held if x[2]]
    n_docs, n_terms = len(held), sum(x[2] for x in held)
    out = []
    for doc, tf, n in held:
        m, score = 50 + 50 * n * n_docs // n_terms, 0
        for t in set(terms_of(query)):
            if df := sum(t in x[1] for x in held):
                score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1))) * (10**9 * tf[t] // (1000 * tf[t] + 20 * m))
        if score:
            out.append((-score, doc is None, doc))
    return [(doc, -s) for s, _, doc in sorted(out, key=lambda x: (x[0], x[1], x[2] or 0))[:k]]


@pytest.mark.parametrize("k,block_terms,shard", [(5, 10**6, 10**6), (3, 10, 40), (50, 25, 1), (1, 10**6, 300)])
def test_ranked_search(spark, docs, texts, k, block_terms, shard):
    rng = random.Random(k)
    items = [(0, prose(rng, 12)), (1, "STONE1 stone1, river2! Ñandú3"), (2, None), (3, "nowhere"), (1, "river5 stone7"), (4, ""), (5, "one two A"),
             (6, texts[3][1]), (7, "dull line here dull"), (None, "a b c d e x same"), (8, prose(rng, 300))]
    got = ranked_search.search(docs, spark.createDataFrame(items, "item_id long, text string"), k=k, block_terms=block_terms, shard_postings=shard).collect()
    by_row = {}
    for r in got:
        by_row.setdefault((r.iid, r.item_id), []).append((r.rank, r.doc_id, r.score))
    want = Counter((i, tuple(ranked(texts, q, k))) for i, q in items)
    want = Counter({x: n for x, n in want.items() if x[1]})
    have = Counter((i, tuple((d, s) for _, d, s in sorted(v))) for (_, i), v in by_row.items())
    assert have == want
    assert all([x[0] for x in sorted(v)] == list(range(1, len(v) + 1)) for v in by_row.values())


def test_ranked_search_ties_and_empty(spark):
    same = spark.createDataFrame([(i, "tie tie word", "x") for i in range(300, 0, -1)] + [(0, "other", "x")], "doc_id long, text string, lang string")
    item = spark.createDataFrame([(9, "tie")], "item_id long, text string")
    got = ranked_search.search(same.repartition(7), item, k=20, shard_postings=30).orderBy("rank").collect()
    assert [r.doc_id for r in got] == list(range(1, 21)) and len({r.score for r in got}) == 1
    assert ranked_search.search(same.limit(0), item).collect() == []
    assert ranked_search.search(same, item.limit(0)).collect() == []


def test_long_texts_are_cut_between_terms(monkeypatch):
    text = "Ünder_Ground ab12, é" * 50
    whole = ranked_search.term_counts(text.encode())
    monkeypatch.setattr(ranked_search, "PIECE_BYTES", 7)
    assert ranked_search.term_counts(text.encode()) == whole
    assert whole == (Counter(t.encode() for t in terms_of(text)), len(terms_of(text)))


def damaged(rows):
    text = lambda v: " " if v is None else str(v)
    out = []
    for conv, turn, role, body in rows:
        role, body, c = text(role), text(body), zlib.crc32(f"{text(conv)}:{text(turn)}".encode()) % 20
        body = "" if c == 1 else re.sub("[.!?]", "", body) if c == 2 else body
        out += [(conv, turn, "user" if c == 4 else role, body)] * (0 if c == 0 else 2 if c == 3 else 1)
    return out


def repaired(rows):
    """Expected columns of one conversation, by memoised search over all edits, inserts one at a time."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.sha256(r[3].encode()).digest()))
    faults, seen = [], set()
    for _, _, role, body in rows:
        kept = body.rstrip(" \t\n\x0b\x0c\r").lstrip(" \t\n\x0b\x0c\r")
        faults.append("b" if not kept else "d" if (role, body) in seen else "t" if kept[-1] not in ".!?" else "")
        seen.add((role, body))
    initial = [(r[2] or " ")[0] for r in rows]
    after = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}

    @lru_cache(maxsize=None)
    def best(i, last, inserted):
        options = []
        if i == len(rows) and last in ("", "a"):
            options.append((0, "", ()))
        if i < len(rows):
            late = 5 if faults[i] == "t" else 0
            c, a, o = best(i + 1, last, 0)
            options.append((c + 2, "D" + a, o))
            if faults[i] not in ("b", "d"):
                if initial[i] in after[last]:
                    c, a, o = best(i + 1, initial[i], 0)
                    options.append((c + late, "K" + a, (f"{rows[i][2]}:{rows[i][3]}",) + o))
                for x, name in (("u", "user"), ("a", "assistant")):
                    if x in after[last]:
                        c, a, o = best(i + 1, x, 0)
                        options.append((c + 1 + late, "R" + a, (f"{name}:{rows[i][3]}",) + o))
        if inserted < 3:
            for x, name in (("u", "user:"), ("a", "assistant:")):
                if x in after[last]:
                    c, a, o = best(i, x, inserted + 1)
                    options.append((c + 5, "I" + a, (name,) + o))
        return min(options, default=(10**9, "", ()))

    cost, audit, out = best(0, "", 0)
    turns = [r[1] for r in rows if r[1] is not None]
    illegal = sum(x + y not in ("su", "ua", "au") for x, y in zip(initial, initial[1:]))
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults.count("b"), faults.count("d"), faults.count("t"), illegal,
            cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest())


@pytest.fixture(scope="module")
def turns():
    rng = random.Random(4)
    bodies = ["Yes.", "No!", "open end", "", " \n", "Why? ", "é.", "Yes."]
    rows = [(c, t, rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None]), rng.choice(bodies + [None, f"say {t}.", f"cut {t}"]))
            for c in range(60) for t in range(rng.randrange(1, 9))]
    rows += [(100, t, "user", f"hot {t}.") for t in range(700)]  # one long run
    rows += [(101, t, ("user", "assistant", "assistant")[t % 3], f"w {t}" + "." * (t % 2)) for t in range(90)]
    rows += [(102, None, "system", "s."), (102, None, "user", "u."), (102, 5, "assistant", "a."), (102, 9, "assistant", "a."), (103, None, "user", "x.")]
    rows += [(None, 1, "user", "q?"), (None, 2, "assistant", "a.")] + [(104, 3, "user", "twice."), (104, 3, "user", "twice.")]
    return rows


@pytest.mark.parametrize("segment_rows", [1 << 20, 7])
def test_repair(spark, turns, monkeypatch, segment_rows):
    monkeypatch.setattr(conversation_repair, "SEGMENT_ROWS", segment_rows)
    table = spark.createDataFrame([(*r, "x", 1) for r in turns], "conv_id long, turn long, role string, text string, conv string, seg long").repartition(3)
    got = conversation_repair.repair(conversation_repair.damaged(table), table).collect()
    rows = {}
    for r in damaged(turns):
        rows.setdefault(r[0], []).append(r)
    assert len(got) == len({r[0] for r in turns}) == len({r.conv_id for r in got})
    for r in got:
        assert tuple(r)[1:] == repaired(rows.get(r.conv_id, [])), r.conv_id


def test_repair_of_nothing(spark):
    table = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert conversation_repair.repair(conversation_repair.damaged(table), table).collect() == []
    ids = spark.createDataFrame([(7,), (None,), (7,)], "conv_id long")
    got = {r.conv_id: tuple(r)[1:] for r in conversation_repair.repair(table, ids).collect()}
    assert got == {k: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) for k in (7, None)}
