"""Filter audit, language identification and resampling against brute force."""

import hashlib
import itertools
import math
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from feedlake.llm import audit, langid, resampling
from feedlake.llm.common import Scratch

DOCS = "doc_id long, text string, lang string, extra string"
ASCII = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
LONG = " ".join(f"w{i % 137}x{i}" for i in range(60_000))


def odd_documents():
    prose = " ".join(f"word{i}" for i in range(120))
    return [
        (0, None, "en", "x"), (1, "", "en", "x"), (2, prose, "en", "x"), (3, prose, "de", "x"), (3, prose, "de", "x"),
        (4, "A B C D", None, "x"), (5, "é # é É é", "", "x"), (6, " \t\n", "fr", "x"), (7, LONG, "fr", "x"),
        (8, "same same same " * 40, "fr", "x"), (9, prose + " $", "en", "x"), (None, prose, "en", "x"), (None, prose, "en", "x"),
        (10, "same\x00 same same Same\r\x0bsame", "en", "x"), (11, "ÀÉ ABC 123", "en", "x"),
    ]


LABELS = [(2, 1, 0), (3, 0, 1), (3, 1, 0), (8, 1, 1), (99, 1, 1), (None, 1, 1), (9, None, 1)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(odd_documents(), DOCS).repartition(3).cache()


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")


# -- audit -------------------------------------------------------------------------------


def measures(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return len(words), len(set(words)), len(re.findall("[A-Z]", text)), len(text), len(re.findall(r"[#$%&*|]", text))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="aAbB é$#\n\t  \x00🙂", max_size=30), min_size=1, max_size=8))
def test_transducer_measures_texts(texts):
    raw = [t.encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    data = np.frombuffer(b"".join(raw), np.uint8)
    for chunk in (1, 7, 1 << 20):
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(audit, "CHUNK", chunk)
            found = audit.Measurer().measure(data, offsets)
        assert [tuple(r) for r in found.tolist()] == [measures(t) for t in texts]


def test_words_with_one_hash_are_told_apart(monkeypatch):
    """With a hash of two values every entry has to be verified."""
    text = b"ab ba ab cc dd ab aab ba " * 5
    monkeypatch.setattr(audit.Measurer, "hashes", lambda self, data, begins, stops: (stops - begins).astype(np.uint64) % np.uint64(2))
    found = audit.Measurer().measure(np.frombuffer(text, np.uint8), np.array([0, 25, len(text)]))
    assert found[:, 1].tolist() == [5, 5]


def brute_audit(rows, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    fails, text_of = [], lambda r: r[1] or ""
    for row in rows:
        words, distinct, capitals, points, symbols = measures(text_of(row))
        copy = row[0] is not None and any(o[0] is not None and o[0] < row[0] and text_of(o) == text_of(row) for o in rows)
        own = {"A": words < 100, "B": 100 * distinct < 80 * words, "C": 100 * capitals > 10 * points, "D": symbols > 0, "E": copy}
        fails.append((row[2] or "", {k for k, v in own.items() if v}, row[0] in good, row[0] in toxic))
    out, removed_by = {}, {}
    for part in {f[0] for f in fails}:
        for order in map("".join, itertools.permutations("ABCDE")):
            left = [f for f in fails if f[0] == part]
            for step, letter in enumerate(order, 1):
                removed = [f for f in left if letter in f[1]]
                left = [f for f in left if letter not in f[1]]
                failing = [f for f in fails if f[0] == part and letter in f[1]]
                unique = sum(f[1] == {letter} for f in failing)
                out[part, order, step] = (len(left), len(removed), len(failing) - len(removed), unique, sum(f[2] for f in removed), sum(f[3] for f in removed))
                removed_by[part, letter] = removed_by.get((part, letter), 0) + len(removed)
    return {k: (*v, removed_by[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def test_audit_equals_brute_force(docs, labels):
    found = {tuple(r[:3]): tuple(r[3:]) for r in audit.audit_filters(docs, labels).collect()}
    assert found == brute_audit(odd_documents(), LABELS)


def test_audit_of_nothing_and_without_labels(docs, labels):
    assert audit.audit_filters(docs.limit(0), labels).count() == 0
    bare = audit.audit_filters(docs, labels.limit(0))
    assert bare.count() == 600 * 4 and bare.agg(F.sum("good_lost") + F.sum("toxic_lost")).head()[0] == 0


def test_audit_ignores_clashing_columns(spark, labels):
    rows = [(i, "a b", "en", 5, 7, "s") for i in range(3)]
    clash = spark.createDataFrame(rows, "doc_id long, text string, lang string, n_words int, fails int, sha string")
    first = audit.audit_filters(clash, labels).filter("filter_order = 'EABCD' AND step = 1").head()
    assert (first.kept, first.removed) == (1, 2)


# -- language ----------------------------------------------------------------------------


def speech(lang, seed, count=60):
    """Made-up words of a language: its own syllables."""
    syllables = {"aa": ["ka", "to", "mi", "re"], "bb": ["schu", "ge", "ach", "lig"], "cc": ["ñol", "ció", "que", "dad"]}[lang]
    rng = np.random.default_rng(seed)
    return " ".join("".join(rng.choice(syllables, rng.integers(2, 4))) for _ in range(count))


@pytest.fixture(scope="module")
def field(spark):
    rows = [(i, speech(lang, i), lang) for i, lang in enumerate(["aa", "bb", "cc"] * 40)]
    rows += [(1000, None, "aa"), (1001, "", "bb"), (1002, "123", "cc"), (None, speech("aa", 5), "bb"), (1003, speech("aa", 6), None)]
    return langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))


def test_forward_backward_equals_enumeration():
    rng = np.random.default_rng(0)
    field = langid.Field(["a", "b", "c"])
    field.moves, field.start = rng.normal(size=(3, 3)).astype(np.float32), rng.normal(size=3).astype(np.float32)
    scores = rng.normal(size=(3, 6, 3)).astype(np.float32)
    real = np.array([[1, 1, 1, 1, 1, 1], [0, 0, 1, 1, 1, 0], [1, 0, 0, 0, 0, 0]], bool)
    found, moved, log = field.marginals(scores, real)
    expected_moves = np.zeros((3, 3))
    for c in range(3):
        places = np.flatnonzero(real[c])
        weight, by_place = {}, np.zeros((6, 3))
        for path in itertools.product(range(3), repeat=len(places)):
            total = field.start[path[0]] + sum(scores[c, p, y] for p, y in zip(places, path, strict=True))
            total += sum(field.moves[a, b] for a, b in itertools.pairwise(path))
            weight[path] = math.exp(total)
        norm = sum(weight.values())
        for path, w in weight.items():
            for p, y in zip(places, path, strict=True):
                by_place[p, y] += w / norm
            for a, b in itertools.pairwise(path):
                expected_moves[a, b] += w / norm
        assert np.allclose(found[c], by_place, atol=1e-5)
        assert log[c] == pytest.approx(math.log(norm), abs=1e-4)
    assert np.allclose(moved, expected_moves, atol=1e-4)


def test_held_out_texts_are_told_apart(spark, field):
    rows = [(i, speech(lang, 5000 + i, 8), lang, "kept", "old") for i, lang in enumerate(["aa", "bb", "cc"] * 20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, extra string, LANG_PRED string")
    out = langid.identify(docs, field)
    assert out.columns == ["doc_id", "text", "lang", "extra", "lang_pred", "score"]
    assert all(r.lang_pred == r.lang and 0.5 < r.score <= 1 for r in out.collect())


def test_transitions_are_learned(field):
    stay = np.diag(field.moves)
    assert (stay > field.moves.max(axis=1, where=~np.eye(3, dtype=bool), initial=-9)).all()


def test_switches_are_found(spark, field):
    first, second = speech("aa", 77, 40), speech("bb", 78, 30)
    docs = spark.createDataFrame([(1, f"é… {first}. {second}!"), (2, ""), (3, None), (4, "12")], "doc_id long, text string")
    found = {r.doc_id: r.segments for r in langid.segments(docs, field).collect()}
    assert found[2] == found[3] == found[4] == []
    runs = [r for r in found[1] if r.words > 3]
    assert [r.lang for r in runs] == ["aa", "bb"]
    text = f"é… {first}. {second}!"
    assert text[runs[1].start : runs[1].end] == second and sum(r.words for r in found[1]) == 71


def test_texts_without_letters_are_undetermined(spark, field):
    rows = [(None, None), (1, ""), (2, "123 !? $"), (3, "  … ☃"), (4, "x"), (5, speech("bb", 9, 50_000))]
    found = {r.doc_id: (r.lang_pred, r.score) for r in langid.identify(spark.createDataFrame(rows, "doc_id long, text string"), field).collect()}
    assert all(found[k] == ("und", 0.0) for k in (None, 1, 2, 3))
    assert found[4][0] in field.labels and found[5][0] == "bb"


def test_long_texts_count_as_their_words(field):
    text = (speech("aa", 1, 500) + " " + speech("cc", 2, 400)).encode()
    data = np.frombuffer(text, np.uint8)
    mean = langid.Labeller(field).texts(data, np.array([0, len(data)]))[0]
    assert mean == pytest.approx([500 / 900, 0, 400 / 900], abs=0.02)


def test_language_without_lessons_or_documents(spark):
    none = spark.createDataFrame([], "doc_id long, text string, lang string")
    empty = langid.fit(none)
    one = langid.identify(spark.createDataFrame([(1, "word", None)], "doc_id long, text string, lang string"), empty).head()
    assert (one.lang_pred, one.score) == ("und", 0.0)
    single = langid.fit(spark.createDataFrame([(1, "word", "xx")], "doc_id long, text string, lang string"))
    assert langid.identify(none, single).count() == 0
    assert langid.identify(spark.createDataFrame([(1, "other")], "doc_id long, text string"), single).head().lang_pred == "xx"


# -- resampling --------------------------------------------------------------------------


def brute_resample(rows, target, percent, least, buckets, longest, seed):
    def features(text):
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(ASCII))
        runs = [" ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]
        return len(words), [zlib.crc32(r.encode()) % buckets for r in runs]

    s, t = np.zeros(buckets, int), np.zeros(buckets, int)
    for text, into in [(r[1], s) for r in rows] + [(x, t) for x in target]:
        np.add.at(into, features(text)[1], 1)
    gain = [math.floor(1000 * math.log((b + 1) * (s.sum() + buckets) / ((a + 1) * (t.sum() + buckets)))) for a, b in zip(s, t, strict=True)]
    out = []
    for row in rows:
        words, own = features(row[1])
        weight = sum(gain[b] for b in own) // len(own) if own else 0
        h = int(hashlib.sha256(f"{seed}:{'' if row[0] is None else row[0]}".encode()).hexdigest()[:8], 16)
        out.append([row[0], words, len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))])
    order = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    drawn = [tuple(r) for r in order[: len(order) * percent // 100]]
    return sorted(map(tuple, out), key=str), drawn


@pytest.mark.parametrize("percent, least, buckets, longest", [(10, 20, 10_000, 1), (50, 2, 17, 1), (100, 0, 300, 3), (0, 0, 5, 2)])
def test_resampling_equals_brute_force(spark, docs, percent, least, buckets, longest):
    rows = odd_documents() + [(i, " ".join(["alpha", "Beta", "gäm"][j % 3] for j in range(i % 40)), "en", "x") for i in range(100, 300)]
    target = ["alpha beta", "word1 word2 É", None, ""]
    frame = spark.createDataFrame(rows, DOCS).repartition(5)
    wanted = spark.createDataFrame([(t,) for t in target], "text string")
    out = resampling.draw(resampling.weigh(frame, wanted, buckets, longest, seed=7), percent, least)
    found = out.select("doc_id", "n_words", "n_features", "weight", "score", "rank", "extra").collect()
    all_rows, drawn = brute_resample(rows, target, percent, least, buckets, longest, 7)
    assert sorted((tuple(r[:5]) for r in found), key=str) == all_rows
    ranked = sorted((r for r in found if r.rank is not None), key=lambda r: r.rank)
    assert [r.rank for r in ranked] == list(range(1, len(drawn) + 1))
    assert [tuple(r[:5]) for r in ranked] == drawn


@pytest.mark.parametrize("pivots", [1, 2, 31])
def test_quickselect_finds_every_place(spark, tmp_path, monkeypatch, pivots):
    monkeypatch.setattr(resampling, "PIVOTS", pivots)
    rows = [((i * 7) % 5, (i % 3 == 0, None if i % 3 == 0 else i % 4), i) for i in range(40)]
    keys = spark.createDataFrame(rows, "first long, second struct<missing boolean, id long>, third long")
    order = sorted(rows, key=resampling._order)
    scratch = Scratch(spark, "test-quickselect")
    for k in (1, 2, 20, 39, 40):
        equal = keys.filter(resampling._key() == resampling.kth_key(keys, k, scratch)).collect()
        assert [r.third for r in equal] == [order[k - 1][2]]


def test_resampling_of_nothing_and_clashing_columns(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    wanted = spark.createDataFrame([("a",)], "text string")
    assert resampling.draw(resampling.weigh(empty, wanted)).count() == 0
    rows = spark.createDataFrame([(1, "a b", 5, "r", 2)], "doc_id int, text string, SCORE int, rank string, words int")
    out = resampling.draw(resampling.weigh(rows, empty.select("text")), 100, 1)
    assert out.columns == ["doc_id", "text", "words", "n_words", "n_features", "weight", "score", "rank"]
    assert out.head().rank == 1 and out.head().words == 2
