"""Bag search, spelling variants and language codes against brute force: nulls, empty and very long texts, ties,
repeated rows, empty tables and extra columns whose names clash with inner ones."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from quern.llm import bag_search, language, spelling

EXTRA = ("n bigint, terms string, tfs string, m double, members string, score double, rank string, hash string, place string, item_no int, "
         "word string, slot int, branch string, lang_pred string, ambiguous int, draw string")
CLASH = (1, "t", "f", 0.5, "m", 0.1, "r", "h", "p", 7, "w", 3, "b", "l", 1, "d")


# ---------------------------------------------------------------- ranked search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def ranked(items, docs, k):
    """Every item against every document, as the contract words it."""
    bags = [(doc, Counter(TERM.findall(lowered(text)))) for doc, text in docs]
    bags = [(doc, bag) for doc, bag in bags if bag]
    total, length = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    rows = []
    for item, text in set(items):
        asked, found = Counter(TERM.findall(lowered(text))), []
        for doc, bag in bags:
            mark = 100 - 25 + (25 * sum(bag.values()) * total) // length
            score = sum(q * math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * bag[t]) // (1000 * bag[t] + 12 * mark))
                        for t, q in asked.items() if t in bag)
            if score > 0:
                found.append((-score, doc is None, doc if doc is not None else 0, doc))
        rows += [(item, place, hit[3], -hit[0]) for place, hit in enumerate(sorted(found, key=lambda h: h[:3])[:k], 1)]
    return sorted(rows, key=repr)


def search_rows():
    rng = random.Random(3)
    words = [f"w{i}" for i in range(40)] + ["É", "ñandú", "x", "THE"]
    docs = [(1, None), (2, ""), (3, " .,- "), (4, "Tie tie w1"), (5, "tie Tie; W1"), (5, "tie Tie; W1"), (None, "w1 w2 no id"), (None, None),
            (6, "w3 " * 30_000), (7, "q" * 50_000)]
    docs += [(100 + i, "hot copy w1 w2 w7") for i in range(60)]
    docs += [(10 + i, " ".join(rng.choices(words, k=rng.randint(1, 60)))) for i in range(80)]
    docs += [(300 + i, docs[75 + i % 9][1] + (" unasked" if i % 2 else " other")) for i in range(30)]
    rng.shuffle(docs)
    items = [(i, " ".join(rng.choices(words, k=rng.randint(1, 12)))) for i in range(12)]
    items += [(50, None), (51, ""), (52, "nowhere"), (53, "w1 w1 tie"), (53, "w1 w1 tie"), (53, "w2"), (None, "w7 hot"), (54, "É")]
    return items, docs


def as_tables(spark, items, docs, id_type="bigint"):
    return (spark.createDataFrame([(*r, *CLASH) for r in items], f"item_id bigint, text string, {EXTRA}"),
            spark.createDataFrame([(*r, *CLASH) for r in docs], f"doc_id {id_type}, text string, {EXTRA}"))


@pytest.mark.parametrize("k", [1, 4, 20])
def test_search_equals_all_pairs(spark, k):
    items, docs = search_rows()
    got = bag_search.search(*as_tables(spark, items, docs), k=k)
    assert sorted(map(tuple, got.collect()), key=repr) == ranked(items, docs, k)


def test_blocks_of_items_change_nothing(spark, monkeypatch):
    items, docs = search_rows()
    monkeypatch.setattr(bag_search, "CLASSES_AT_ONCE", 7)
    monkeypatch.setattr(bag_search, "ITEMS_AT_ONCE", 3)
    got = bag_search.search(*as_tables(spark, items, docs), k=5, block_terms=20)
    assert sorted(map(tuple, got.collect()), key=repr) == ranked(items, docs, 5)


def test_search_with_text_ids_and_empty_tables(spark):
    items, docs = search_rows()
    texts = [(None if i is None else f"d{i:04}", t) for i, t in docs]
    got = bag_search.search(*as_tables(spark, items, texts, "string"), k=3).collect()
    assert [(r.item_id, r.rank, r.doc_id, r.score) for r in sorted(got, key=lambda r: (str(r.item_id), r.rank, r.score))] == [
        (i, r, None if d is None else f"d{d:04}", s) for i, r, d, s in sorted(ranked(items, docs, 3), key=lambda r: (str(r[0]), r[1], r[3]))]
    for some, others in (([], docs), (items, []), ([(1, None)], docs), (items, [(1, ""), (2, None)])):
        found = bag_search.search(*as_tables(spark, some, others))
        assert found.columns == ["item_id", "rank", "doc_id", "score"] and found.count() == 0


def test_classes_hold_equal_vectors_once(spark):
    docs = [(i, "w1 w2 w1") for i in range(50)] + [(99, "w2 w1 w1"), (98, "w1 w2 w1 z"), (97, "w1 w2 z w1")]
    _, table = as_tables(spark, [], docs)
    vectors = bag_search.restricted(table, [b"w1", b"w2"], "text", "doc_id")
    classes = bag_search.classes_of(vectors, F.col("n"), 4).collect()
    assert sorted((r.terms, r.tfs, r.m, r.members) for r in classes) == [([0, 1], [2, 1], 3, [0, 1, 2, 3]), ([0, 1], [2, 1], 4, [97, 98])]


# ---------------------------------------------------------------- spelling variants

def one_edit(u, v):
    if len(u) == len(v):
        return sum(a != b for a, b in zip(u, v)) == 1
    short, long = sorted((u, v), key=len)
    return len(long) == len(short) + 1 and any(long[:i] + long[i + 1:] == short for i in range(len(long)))


def variants(docs):
    """The contract over all pairs of words."""
    total = Counter()
    for row_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = lowered(run)
            h = zlib.crc32(f"{'' if row_id is None else row_id}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            total[run] += 1
    n = {w: c for w, c in total.items() if len(w) >= 5 and c >= 3}
    near = {w: [v for v in n if abs(len(v) - len(w)) < 2 and one_edit(w, v)] for w in n}
    form = {w: min(vs, key=lambda v: (-n[v], v)) for w, vs in near.items() if vs and max(n[v] for v in vs) >= 2 * n[w]}

    def root(w):
        return root(form[w]) if w in form else w
    return sorted((w, n[w], len(near[w]), form.get(w, ""), n.get(form.get(w), 0), root(w)) for w in n)


def spelling_rows():
    rng = random.Random(11)
    letters = "abcdeé÷"
    stems = ["".join(rng.choices(letters, k=rng.randint(5, 8))) for _ in range(60)]
    docs = [(1, None), (2, ""), (3, "123 ..."), (4, "Ünter ünter UNTER unter Éclair éclair"), (None, " ".join(stems[:9] * 4)), (None, " ".join(stems[:9]))]
    for i in range(40):
        words = []
        for _ in range(120):
            w = rng.choice(stems[:20] if rng.random() < 0.5 else stems)
            if rng.random() < 0.3:
                at = rng.randrange(len(w))
                w = rng.choice([w[:at] + w[at + 1:], w[:at] + rng.choice(letters) + w[at:], w[:at] + rng.choice(letters) + w[at + 1:]])
            words.append(w.upper().replace("É", "é") if rng.random() < 0.1 else w)
        docs.append((10 + i, " ".join(words)))
    docs += docs[-3:]
    docs += [(90 + i, "a" * 70_000 + " " + "a" * 69_999 + " " + "a" * 69_998 + "b") for i in range(3)]
    docs += [(95, "chain chaib chaic " + "chain " * 20 + "chais " * 9 + "chais chats chats chats chats")] * 2
    return docs


def spelled(rows):
    return sorted((r.word, r.n, r.n_near, r.form or "", r.form_n or 0, r.root) for r in rows)


@pytest.fixture(scope="module")
def word_table(spark):
    return spark.createDataFrame([(i, t, *CLASH) for i, t in spelling_rows()], f"doc_id bigint, text string, {EXTRA}")


def test_variants_equal_all_pairs(word_table):
    found = spelled(spelling.group_variants(word_table).collect())
    assert found == variants(spelling_rows())
    assert any(f and r != f for _, _, _, f, _, r in found) and any(len(w) > 60_000 and c for w, _, c, *_ in found)


def test_slots_slices_and_frontier_change_nothing(word_table, monkeypatch):
    words = spelling.count_words(word_table).cache()
    whole = {tuple(r) for r in spelling.near_words(words).collect()}
    monkeypatch.setattr(spelling, "FRONTIER", 50)
    monkeypatch.setattr(spelling, "LETTERS_AT_ONCE", 1000)
    for levels, size in ((1, 40), (2, 100), (5, 10)):
        assert {tuple(r) for r in spelling.near_words(words, levels, size).collect()} == whole


def test_pairs_come_up_once():
    rng = random.Random(2)
    words = sorted({bytes(rng.choices(b"abc\xe9", k=rng.randint(1, 5))) for _ in range(300)})
    found = [tuple(sorted((words[i], words[j]))) for u, v in spelling.near_in_slot(words, np.ones(len(words), dtype=bool)) for i, j in zip(u, v)]
    assert sorted(found) == sorted((u, v) for u in words for v in words if u < v and one_edit(u, v))


def test_roots_of_long_chains(spark):
    links = spark.createDataFrame([(f"w{i}", f"w{i + 1}") for i in range(20)] + [("x", "w20"), ("y", "z")], "word string, form string")
    assert {tuple(r) for r in spelling.roots(links).collect()} == {*((f"w{i}", "w20") for i in range(20)), ("x", "w20"), ("y", "z")}


def test_words_of_nothing(spark, word_table):
    found = spelling.group_variants(word_table.limit(0))
    assert found.columns == ["word", "n", "n_near", "form", "form_n", "root"] and found.count() == 0
    alone = spark.createDataFrame([(1, "lonely " * 3), (2, None)], "doc_id int, text string")
    assert spelled(spelling.group_variants(alone).collect()) == variants([(1, "lonely " * 3)])


# ---------------------------------------------------------------- language codes

SYLLABLES = {"aa": "ba be bi bo bu da de di do".split(), "bb": "szk cz rz prz ów ść ął ki".split(), "cc": "ing the ed tion wh ough ly st".split(),
             "dd": "eau oux ique aire è ère on".split(), "ee": "ñas ción os ado ó del ez".split()}


def spoken(lang, n, rng):
    return " ".join("".join(rng.choices(SYLLABLES[lang], k=rng.randint(1, 3))) for _ in range(n)).capitalize() + "."


def language_rows(langs, each, seed=1):
    rng = random.Random(seed)
    rows = [(1000 * a + i, spoken(lang, rng.randint(3, 40), rng), lang) for a, lang in enumerate(langs) for i in range(each)]
    return rows + [(9001, None, "aa"), (9002, "", "bb"), (9003, "12 ½ 34!", "cc"), (9004, spoken("aa", 20, rng), None), (None, spoken("cc", 20, rng), "cc"),
                   (9005, spoken("dd", 60_000, rng), "dd"), (9006, spoken("dd", 30, rng), "dd"), (9006, spoken("dd", 30, rng), "dd")]


def language_table(spark, rows):
    return spark.createDataFrame([(*r, *CLASH) for r in rows], f"doc_id bigint, text string, lang string, {EXTRA}")


def identified(spark, rows, **options):
    docs = language_table(spark, rows)
    return language.predict(docs, language.fit(docs, **options), keep=["doc_id", "lang", "text"]).collect()


def test_held_out_rows_are_identified(spark):
    found = identified(spark, language_rows(SYLLABLES, 150), per_language=60)
    letters = [r for r in found if r.text and any(c.isalpha() for c in r.text)]
    unseen = [r for r in letters if r.lang and r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert len(unseen) > 100 and np.mean([r.lang == r.lang_pred for r in unseen]) >= 0.98
    assert all(0 < r.score <= 1 for r in letters)
    assert [(r.lang_pred, r.score, r.ambiguous) for r in found if r not in letters] == [("und", 0.0, True)] * 3
    by_id = {r.doc_id: r for r in found}
    assert by_id[9004].lang_pred == "aa" and by_id[None].lang_pred == "cc" and by_id[9005].lang_pred == "dd"
    assert len([r for r in found if r.doc_id == 9006]) == 2


def test_mixed_text_is_flagged_more_than_clean_text(spark):
    rng = random.Random(7)
    docs = language_table(spark, language_rows(SYLLABLES, 80))
    model = language.fit(docs)
    clean = [spoken(lang, 40, rng) for lang in SYLLABLES for _ in range(20)]
    mixed = [spoken("aa", 40, rng) + " " + spoken("cc", 40, rng) for _ in range(60)]
    flags = [model.decode(texts)[2].mean() for texts in (clean, mixed)]
    assert flags[0] < 0.05 and flags[1] > flags[0] + 0.2


def test_learned_tables_by_hand(spark):
    rows = language_rows(["aa", "bb", "cc"], 12)
    docs = language_table(spark, rows)
    drawn = language.training_rows(docs, "text", "doc_id", "lang", 2_000).collect()
    allowed = [(lang, text) for i, text, lang in rows if text and any(c.isalpha() for c in text) and lang and i is not None
               and zlib.crc32(str(i).encode()) % 5 != 0]
    assert sorted((r.lang, r.text) for r in drawn) == sorted(allowed)
    counts = {}
    for lang, text in allowed:
        for word in re.findall(r"[^\W\d_]+", text.lower()):
            padded = f" {word} "
            for n in range(1, language.ORDERS + 1):
                for i in range(len(padded) - n + 1):
                    if padded[i:i + n] != " ":
                        counts[lang, padded[i:i + n]] = counts.get((lang, padded[i:i + n]), 0) + 1
    found = {(r.lang, r.bucket): r.n for r in language.gram_counts(language.training_rows(docs, "text", "doc_id", "lang", 2_000)).collect()}
    by_hand = Counter()
    for (lang, gram), n in counts.items():
        h = 0
        for c in gram:
            h = (h * 0x100000001B3 + ord(c)) % 2**64
        by_hand[lang, ((h ^ len(gram)) * 0x9E3779B97F4A7C15 % 2**64) >> (64 - language.BITS)] += n
    assert found == dict(by_hand)
    table = np.array([[5.0, 1, 0], [0, 4, 2], [3, 3, 3]])
    codes = language.code_matrix(3)
    share = (table + 0.5) / (table + 0.5).sum(1, keepdims=True)
    for bit in range(codes.shape[1]):
        up, down = share[codes[:, bit] == 1].mean(0), share[codes[:, bit] == -1].mean(0)
        assert np.allclose(language.bit_classifiers(table, codes)[:, bit], np.log(up / down))


def test_training_rows_are_bounded(spark):
    rows = [(i, "same text of all", "aa") for i in range(400)] + [(7, "repeated", "bb")] * 300 + [(i, f"text {i}", "cc") for i in range(1000, 1040)]
    drawn = Counter(r.lang for r in language.training_rows(language_table(spark, rows), "text", "doc_id", "lang", 25).collect())
    assert drawn["aa"] == 25 and drawn["cc"] == 25 and drawn["bb"] in (0, 25)


@pytest.mark.parametrize("n", [2, 4, 7, 12, 40])
def test_codewords_correct_errors(n):
    codes = language.code_matrix(n)
    assert codes.shape[0] == n and set(np.unique(codes)) <= {-1, 1} and (abs(codes.sum(0)) < n).all()
    apart = min((codes[i] != codes[j]).sum() for i in range(n) for j in range(i))
    assert apart >= max(1, codes.shape[1] // 4)
    bits = codes.shape[1]
    model = language.EcocModel([str(i) for i in range(n)], codes, np.zeros((1, bits)), np.ones(bits), np.zeros(bits), np.full(codes.shape, 1 / bits))
    for flips in range((apart - 1) // 2 + 1):
        heard = 3.0 * codes
        heard[:, :flips] *= -1
        assert (model.losses(heard).argmin(1) == np.arange(n)).all()


def test_few_languages_and_no_rows(spark):
    assert {(r.lang_pred, r.score) for r in identified(spark, [(2, "abc", None), (3, None, None)])} == {("und", 0.0)}
    one = identified(spark, [(i, "some words", "xx") for i in range(20)] + [(99, "", None)])
    assert {(r.lang_pred, r.score, r.ambiguous) for r in one} == {("xx", 1.0, False), ("und", 0.0, True)}
    empty = language_table(spark, [])
    found = language.predict(empty, language.fit(empty))
    assert found.count() == 0 and {"lang_pred_", "score_", "ambiguous_"} <= set(found.columns)
