"""Small tests of the training-data operators: brute force, exact round trips and edge cases."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter
from math import log10

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from notecodes.llm import brown, decontaminate, extract, fingerprint, langid, neardup, packing, quality, textnum, toxicity, url_rules
from notecodes.llm.common import staged

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score string, kept string, node long"
LOW = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def words_of(text, pattern=r"[^\x20\x09-\x0D]+"):
    return re.findall(pattern, (text or "").translate(LOW))


def prose(rng, n, stems=("ka", "lo", "mi", "ren", "tas", "vu", "xe")):
    return " ".join("".join(rng.choices(stems, k=rng.randint(1, 4))) for _ in range(n))


def corpus(seed=1):
    """(doc_id, text): copies, near copies, a shared passage, short, empty, null, repeated and very long texts."""
    rng = random.Random(seed)
    base, passage = prose(rng, 120), prose(rng, 60)
    texts = [prose(rng, rng.randint(8, 200)) for _ in range(30)]
    for _ in range(25):
        w = base.split()
        for _ in range(rng.randint(0, 6)):
            w[rng.randrange(len(w))] = prose(rng, 1)
        texts.append(" ".join(w))
    texts += [passage + " " + prose(rng, rng.randint(2, 40)) for _ in range(25)]
    texts += [base, base, base.upper(), None, "", "  \n\t ", "one", "one two three", "ONE two  three", "a b c d e", "Ünï cödé ß 日本 wörds here now", prose(rng, 30_000)]
    return list(enumerate(texts))


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), "x", "y", 7) for i, t in rows], DOCS)


@pytest.fixture(scope="module")
def docs(spark):
    return frame(spark, corpus()).repartition(4).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def shingles(text):
    w = words_of(text)
    return frozenset(tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()


def groups(rows):
    sets = {i: shingles(t) for i, t in rows}
    head = {i: i for i in sets}

    def find(x):
        while head[x] != x:
            x = head[x]
        return x

    for i in sets:
        for j in sets:
            both = len(sets[i] & sets[j])
            if j < i and both and 100 * both >= 75 * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                head[b] = a
    return {i: (len(sets[i]), find(i), find(i) == i) for i in sets}


def test_words_and_hashes_match_regex():
    import pyarrow as pa

    texts = ["A b\u00a0C", None, " x\ty\n", "ß1-É2_z 3", ""]
    data, offsets = textnum.buffer_of(pa.array(texts))
    for table, pattern in ((textnum.NON_SPACE, r"[^\x20\x09-\x0D]+"), (textnum.ALNUM, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")):
        low = textnum.lower_ascii(data)
        w = textnum.words_of(low, offsets, table)
        raw = low.tobytes()
        got = [[raw[s:e].decode() for s, e in zip(w.start[a:b], w.end[a:b])] for a, b in zip(w.first, w.first[1:])]
        assert got == [words_of(t, pattern) for t in texts]
    assert len(set(textnum.words_of(*textnum.buffer_of(pa.array(["ab ba ab aa a"])), textnum.NON_SPACE).hash.tolist())) == 4


def test_op10_matches_brute_force(docs):
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in neardup.near_duplicates(docs).collect()}
    assert got == groups(corpus())


def test_op10_long_lists_take_the_exact_way(docs, monkeypatch):
    """With every list that two nodes share counted as long, groups stay the same."""
    monkeypatch.setattr(neardup, "LONG", 3)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in neardup.near_duplicates(docs).collect()}
    assert got == groups(corpus())


def test_op10_repeated_ids_nulls_and_empty(spark, none):
    rows = [(1, "a b c d e f"), (1, "p q r s t u"), (2, "p q r s t u"), (3, "a b c d e f"), (None, "a b c d e f"), (4, None), (4, None)]
    got = sorted((r.doc_id or -1, r.component_id or -1, r.kept) for r in neardup.near_duplicates(frame(spark, rows)).collect())
    assert got == [(-1, -1, True), (1, 1, True), (1, 1, True), (2, 1, False), (3, 1, False), (4, 4, True), (4, 4, True)]
    heads = sorted((r.doc_id or -1) for r in neardup.group_heads(frame(spark, rows)).collect())
    assert heads == [-1, 1, 4]
    assert neardup.near_duplicates(none).count() == 0


def test_op10_chain_components(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(1, 40)] + [(100, 101), (101, 100)], "a long, b long")
    assert {r.node: r.comp for r in neardup.components(edges).collect()} == {**{i: 1 for i in range(1, 41)}, 100: 100, 101: 100}


ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def contamination_by_hand(rows, items):
    out = {}
    for i, t in rows:
        w, hit, found = words_of(t, ALNUM), set(), set()
        for item, text in items:
            b = words_of(text, ALNUM)
            m = min(10, len(b))
            wins = {tuple(b[k:k + m]) for k in range(len(b) - m + 1)} if m else set()
            for k in range(len(w) - m + 1) if m else ():
                if tuple(w[k:k + m]) in wins:
                    hit.update(range(k, k + m))
                    if item is not None:
                        found.add(str(item))
        out[i] = (len(w), len(hit), sorted(found), bool(hit))
    return out


def test_op6_matches_brute_force(spark, none):
    rng = random.Random(5)
    items = [(k, prose(rng, rng.randint(10, 40))) for k in range(12)] + [(20, "Tiny item here"), (21, "solo"), (22, None), (23, ""), (None, prose(rng, 15)), (9, prose(rng, 12)), (9, prose(rng, 12))]
    rows = []
    for i in range(40):
        w = prose(rng, rng.randint(0, 80)).split()
        for _ in range(rng.randint(0, 3)):
            b = (rng.choice(items)[1] or "").split()
            a = rng.randint(0, max(0, len(b) - 1))
            at = rng.randint(0, len(w))
            w[at:at] = b[a: a + rng.randint(5, 30)]
        rows.append((i, rng.choice([" ", "-", ", "]).join(w).upper()))
    rows += [(50, None), (51, ""), (52, items[0][1] * 1), (53, "x solo y"), (54, "Tiny, item; HERE!")]
    table = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(1))
    for span, gram in ((10, 5),):
        assert (decontaminate.SPAN, decontaminate.GRAM) == (span, gram)
    got = {r.doc_id: (r.n_words, r.n_hit, list(r["items"]), r.contaminated) for r in decontaminate.contamination(frame(spark, rows), table).collect()}
    want = contamination_by_hand(rows, items)
    assert got == want
    left = {r.doc_id for r in decontaminate.without_contaminated(frame(spark, rows + [(None, "clean text")]), table).collect()}
    assert left == {i for i, v in want.items() if not v[3]} | {None}
    assert decontaminate.contamination(none, table).count() == 0
    assert not any(r.contaminated for r in decontaminate.contamination(frame(spark, rows), table.limit(0)).collect())


def test_op6_repeated_rows(spark):
    rows = [(1, "q w e r t y u i o p a"), (1, "q w e r t y u i o p a"), (1, "nothing of it")]
    items = spark.createDataFrame([(5, "q w e r t y u i o p")], "item_id long, text string")
    got = sorted((r.n_words, r.n_hit) for r in decontaminate.contamination(frame(spark, rows), items).collect())
    assert got == [(3, 0), (11, 10), (11, 10)]


def test_op7_ids_equal_the_tokenizers():
    import pyarrow as pa

    rng = random.Random(9)
    alphabet = list("ab'stLL 12\t\n .!é日\u3000\u00a0\u2003\x1c\x00") + ["<|endoftext|>", "  ", " 'll", "ß"]
    texts = ["".join(rng.choices(alphabet, k=rng.randint(0, 60))) for _ in range(300)] + ["", "x" * 5000]
    coder = packing.ChunkEncoder(packing.tokenizer_path())
    for got, text in zip(coder.texts(*textnum.buffer_of(pa.array(texts))), texts):
        assert got.tolist() == coder.tokenizer.encode(text, add_special_tokens=False).ids


def test_op7_plan_is_best_fit_decreasing():
    import bisect

    rng = random.Random(2)
    for size in (1, 8, 60, 2048):
        lengths = [min(size, 1 + int(rng.expovariate(3 / size))) for _ in range(400)]
        bins, taken = [], Counter()
        for x in sorted(lengths, reverse=True):
            i = bisect.bisect_left(bins, x)
            room = bins.pop(i) if i < len(bins) else size
            taken["bins"] += i >= len(bins) + (room != size)
            bisect.insort(bins, room - x)
        rows = packing.plan(dict(Counter(lengths)), size)
        used = {s + r for _, a, b, s, _ in rows for r in range(b - a)}
        assert len(used) == len(bins)
        assert Counter({x: 0}) + Counter(x for x, a, b, _, _ in rows for _ in range(b - a)) == Counter(lengths)


def test_op7_sequences_are_gapless(spark, docs, none, monkeypatch):
    monkeypatch.setattr(packing, "RANK_BUCKET", 20)
    monkeypatch.setattr(packing, "RANK_BLOCK", 4)
    again = docs.unionByName(docs.limit(5))
    got = packing.packed(again).collect()
    by_doc, by_seq = {}, {}
    for r in got:
        by_seq.setdefault(r.sequence_id, []).append((r.offset, r.length))
        by_doc.setdefault(r.doc_id, []).append(r)
    for parts in by_seq.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    coder = packing.ChunkEncoder(packing.tokenizer_path())
    for i, t in corpus():
        ids = coder.tokenizer.encode(t or "", add_special_tokens=False).ids + [0]
        copies = 2 if len(by_doc[i]) > -(-len(ids) // 2048) else 1
        want = []
        at, piece = 0, 0
        while at < len(ids):
            to = at + (len(ids) % 2048 or 2048 if at == 0 else 2048)
            want.append((piece, at, to - at, zlib.crc32(b"".join(x.to_bytes(4, "little") for x in ids[at:to]))))
            at, piece = to, piece + 1
        assert sorted((r.piece, r.start, r.length, r.ids_crc32) for r in by_doc[i]) == sorted(want * copies)
    assert packing.packed(none).count() == 0


def test_op1_fingerprints(spark, docs, none):
    rows = corpus()
    got = {r.doc_id: r for r in fingerprint.edited_fingerprints(docs).collect()}
    assert len(got) == len(rows)
    order = sorted(rows, key=lambda r: -r[0])
    for (i, t), (_, after) in zip(order, order[1:] + order[:1]):
        t, after = t or "", after or ""
        half = len(t) // 2
        edited = t[: len(t) - half] + after[:half]
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        a, b = shingle_texts(t), shingle_texts(edited)
        if a or b:
            assert abs(r.near_edited - len(a & b) / len(a | b)) < 0.17
        assert 0 <= r.near_next <= 1
    assert got[80].fingerprint == got[81].fingerprint != got[82].fingerprint
    assert got[83].fingerprint == got[84].fingerprint == ""
    assert fingerprint.edited_fingerprints(none).count() == 0


def shingle_texts(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    return {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()


def test_op1_next_rows_across_groups(spark, monkeypatch):
    monkeypatch.setattr(fingerprint, "GROUP", 3)
    rng = random.Random(4)
    ids = rng.sample(range(-500, 10**12), 60)
    rows = spark.createDataFrame([(i, f"t{i}") for i in ids] + [(None, "none")], "doc_id long, text string")
    got = {r.doc_id: r.next_text for r in fingerprint.with_next(rows, ["text"]).collect()}
    order = [f"t{i}" for i in sorted(ids, reverse=True)] + ["none"]
    assert [got[i] for i in sorted(ids, reverse=True)] + [got[None]] == order[1:] + order[:1]
    single = spark.createDataFrame([(7, "only")], "doc_id long, text string")
    assert [r.next_text for r in fingerprint.with_next(single, ["text"]).collect()] == ["only"]


def test_op2_base_score_and_counts(spark, docs, none):
    rows = corpus() + [(0, corpus()[0][1])]
    table = docs.unionByName(docs.where("doc_id = 0"))
    held = lambda i: zlib.crc32(str(i).encode()) % 5 == 1
    counts = Counter()
    for i, t in rows:
        if not held(i):
            counts.update(words_of(t) + [None])
    n, v = sum(counts.values()), len(counts)
    got = sorted((r.doc_id, r) for r in brown.scores(table).collect())
    assert [i for i, _ in got] == sorted(i for i, _ in rows)
    texts = dict(rows)
    better = 0
    for i, r in got:
        tokens = words_of(texts[i]) + [None]
        base = sum(log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in tokens)
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held(i), len(tokens), sum(counts[w] > 0 for w in tokens), n)
        assert r.base_score == pytest.approx(base, rel=1e-9)
        assert r.score < 0
        better += r.score > base
    assert brown.scores(none).count() == 0


def test_op2_classes_learn_word_order(spark):
    """Texts that alternate two word kinds: the class model must beat the unigram on held-out texts."""
    rng = random.Random(8)
    a, b = [f"ka{i}" for i in range(30)], [f"lo{i}" for i in range(30)]
    rows = [(i, " ".join(rng.choice(b if k % 2 else a) for k in range(60))) for i in range(200)]
    got = [r for r in brown.scores(frame(spark, rows)).collect() if r.held_out]
    assert got and all(r.score > r.base_score + 5 for r in got)


def test_op2_score_equals_a_plain_class_model(spark, docs, monkeypatch):
    """Classes of all counted words, transitions and scores by dicts; shares are set so that most words go through the joins."""
    monkeypatch.setattr(brown, "UNIT_SHARE", 1 / 150)
    monkeypatch.setattr(brown, "KNOWN_SHARE", 1 / 2000)
    many = brown.CLASSES
    train = [words_of(t) for i, t in corpus() if zlib.crc32(str(i).encode()) % 5 != 1]
    counts = Counter(w for t in train for w in t)
    tokens = sum(counts.values()) + len(train)

    def of(word):
        data, offsets = textnum.buffer_of(textnum.pa.array([word]))
        found = textnum.words_of(data, offsets, textnum.NON_SPACE)
        return int(found.hash[0]), int(brown.forms_of(data, found)[0])

    key = {w: of(w) for t in [words_of(t) for _, t in corpus()] for w in t}
    own = sorted((w for w, n in counts.items() if n >= tokens / 150), key=lambda w: key[w][0])
    looked_up = {w for w, n in counts.items() if n >= tokens / 2000}
    assert 5 < len(own) < len(looked_up) < len(counts)
    unit = {w: 1 + own.index(w) if w in own else 1 + len(own) + key[w][1] for w in key} | {None: 0}
    size = 1 + len(own) + brown.FORMS
    pairs = Counter((unit[a], unit[b]) for t in train for a, b in zip([None, *t], [*t, None]))
    frame_of = spark.createDataFrame([(a * size + b, n) for (a, b), n in pairs.items()], "pair long, n long")
    classes, near = brown.clustered(frame_of, size, many)
    weights = brown.gains(classes, near, many)

    around = {w: np.zeros(2 * many) for w in counts}
    for t in train:
        line = [0, *(classes[unit[w]] for w in t), 0]
        for k, w in enumerate(t):
            around[w][line[k + 2]] += 1
            around[w][many + line[k]] += 1
    chosen = {}
    for w in counts:
        like = near[unit[w]]
        score = (around[w] + brown.PRIOR * like / max(like[:many].sum(), 1)) @ weights
        chosen[w] = classes[unit[w]] if w in own else 1 + int(score[1:].argmax())
    assert any(chosen[w] != classes[unit[w]] for w in counts)
    step = Counter()
    for t in train:
        line = [0, *(chosen[w] if w in looked_up else classes[unit[w]] for w in t), 0]
        step.update(zip(line, line[1:]))
    into, out_of = Counter(), Counter()
    for (a, b), n in step.items():
        into[b] += n
        out_of[a] += n
    total, kinds = Counter({0: len(train)}), Counter()
    for w, n in counts.items():
        total[chosen[w]] += n
        kinds[chosen[w]] += 1

    def score(t):
        line = [0, *(chosen.get(w, classes[unit[w]]) for w in t), 0]
        value = 0.0
        for a, b, w in zip(line, line[1:], [*t, None]):
            unigram = (into[b] + 0.5) / (tokens + 0.5 * many)
            value += log10((step[a, b] + brown.SMOOTH * unigram) / (out_of[a] + brown.SMOOTH))
            value += log10(((counts[w] if w else len(train)) + 0.5) / (total[b] + 0.5 * (kinds[b] + 1)))
        return value

    texts = dict(corpus())
    for r in brown.scores(docs).collect():
        assert r.score == pytest.approx(score(words_of(texts[r.doc_id])), rel=1e-9, abs=1e-9)


def test_op2_nothing_to_learn_from(spark):
    """Only held-out rows: every count is 0, and the scores are those of an empty vocabulary."""
    ids = [i for i in range(60) if zlib.crc32(str(i).encode()) % 5 == 1][:4]
    texts = ["one two one", None, "", "w" * 40_000 + " x" * 2_000]
    got = {r.doc_id: r for r in brown.scores(frame(spark, list(zip(ids, texts)))).collect()}
    assert sorted(got) == ids
    for i, t in zip(ids, texts):
        r, n = got[i], len(words_of(t)) + 1
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (True, n, 0, 0)
        assert r.base_score == pytest.approx(n * log10(0.5 / 0.5)) and r.score <= 0


def test_op2_exchange_stops_when_nothing_is_gained(spark, monkeypatch):
    rng = random.Random(3)
    size, many = 40, 6
    rows = [((a * size) + b, 1 + 30 * ((a + 1) % 5 == b % 5) + rng.randint(0, 2)) for a in range(size) for b in range(size)]
    table = spark.createDataFrame(rows, "pair long, n long")
    turns = []
    plain = brown.exchange
    monkeypatch.setattr(brown, "exchange", lambda *a: turns.append(1) or plain(*a))
    classes, near = brown.clustered(table, size, many)
    assert classes[0] == 0 and (classes[1:] > 0).all() and 2 <= len(turns) < brown.MOST_TURNS
    start = np.array([0, *(1 + i % (many - 1) for i in range(1, size))])
    assert brown.information(classes, near, many) >= brown.information(start, brown.neighbour_counts(table, size, start, many), many) - 0.02


def test_op3_languages(spark, none):
    rng = random.Random(3)
    stems = {"aa": ("ba", "do", "ki"), "bb": ("szt", "ör", "ly"), "cc": ("çe", "ğı", "un")}
    rows = []
    for i in range(150):
        lang = rng.choice(list(stems))
        rows.append((i, prose(rng, 40, stems[lang]).upper() if i % 3 else prose(rng, 40, stems[lang]) + " " + prose(rng, 8, stems["aa"]), lang, "s", 1, "x", "y", 7))
    rows += [(900, None, "aa", "s", 1, "", "", 0), (901, "123 ... !!", "bb", "s", 1, "", "", 0), (902, "ba", None, "s", 1, "", "", 0), (903, "", "aa", "", 0, "", "", 0)]
    got = {r.doc_id: r for r in langid.languages(spark.createDataFrame(rows, DOCS)).collect()}
    truth = {r[0]: r[2] for r in rows if r[0] < 900}
    assert sum(got[i].lang_pred == x for i, x in truth.items()) >= 0.97 * len(truth)
    assert [got[i].lang_pred for i in (900, 901, 902, 903)] == ["und", "und", "aa", "und"]
    assert all(0 <= r.score <= 1 for r in got.values())
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in got.items())
    assert langid.languages(none).count() == 0


def test_op3_every_language_of_a_document(spark):
    rng = random.Random(5)
    stems = {"aa": ("ba", "do", "ki"), "bb": ("szt", "ör", "ly"), "cc": ("çe", "ğı", "un"), "dd": ("wha", "thr", "ee"), "ee": ("ñu", "jaz", "go")}
    rows = [(i, prose(rng, 40, stems[x]), x, "s", 1, "x", "y", 7) for i in range(150) for x in [rng.choice(list(stems))]]
    four, five = list(stems)[:4], list(stems)
    rows += [(900, " ".join(prose(rng, 40, stems[x]) for x in four), "aa", "s", 1, "", "", 0), (902, " ".join(prose(rng, 40, stems[x]) for x in five), "aa", "s", 1, "", "", 0),
             (904, prose(rng, 60, stems["bb"]) + " " + prose(rng, 20, stems["ee"]), "bb", "s", 1, "", "", 0)]
    train = [r for r in rows if r[0] < 900]
    model = langid.learn(spark.createDataFrame(train, DOCS))
    import pyarrow as pa

    names, score, share = model.infer(pa.array([r[1] for r in rows]))
    by = {r[0]: dict(zip(model.langs, s)) for r, s in zip(rows, share)}
    assert all(abs(by[900][x] - 0.25) < 0.05 for x in four) and by[900]["ee"] < 0.01
    assert all(abs(by[902][x] - 0.2) < 0.05 for x in five)
    assert by[904]["bb"] > 0.6 and by[904]["ee"] > 0.1 and by[904]["cc"] == 0
    assert score[len(train)] < 0.3 and all(sorted(by[i].values())[-2] < 0.01 for i in range(150))


def test_op3_equals_plain_em(spark):
    """Counts, likelihoods, expectation-maximisation and the choice of languages word by word in plain Python."""
    import math

    rng = random.Random(8)
    stems = {"aa": ("ba", "do", "ki"), "bb": ("szt", "ör", "ly"), "cc": ("çe", "ğı", "un")}
    rows = [(i, prose(rng, 30, stems[x]), x, "s", 1, "x", "y", 7) for i in range(40) for x in [rng.choice(list(stems))]]
    mixed = [(900 + k, " ".join(prose(rng, rng.randint(1, 25), stems[x]) for x in rng.sample(list(stems), rng.randint(1, 3))), None, "s", 1, "x", "y", 7) for k in range(25)]
    tie = [(990, "zzz", None, "s", 1, "", "", 0), (991, "a1b2", "aa", "s", 1, "", "", 0), (992, prose(rng, 40_000, stems["bb"]), None, "s", 1, "", "", 0)]
    rows += mixed + tie + mixed[:2]  # repeated rows

    def mix(x):
        for shift, by in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53)):
            x = (x ^ x >> shift) * by % 2**64
        return x ^ x >> 33

    def grams(text):
        for word in re.findall(rb"[a-z\x80-\xff]+", (text or "").lower().encode()):
            b = [1, *word, 2]
            yield [mix((b[i] | b[i + 1] << 8 | b[i + 2] << 16) + 1) >> 49 for i in range(len(word))]

    counts = {x: [0.5] * langid.GRAMS for x in stems}
    for i, text, lang, *_ in rows:
        if lang and zlib.crc32(str(i).encode()) % 4 != 2:
            for word in grams(text):
                for g in word:
                    counts[lang][g] += 1
    logs = {x: [math.log(v / math.fsum(c)) for v in c] for x, c in counts.items()}
    langs = sorted(stems)

    def infer(text):
        like = [[sum(logs[x][g] for g in word) for x in langs] for word in grams(text)]
        like = [[math.exp(max(v - max(w), -60.0)) for v in w] for w in like]
        alone = [math.fsum(math.log(max(w[j], 1e-26)) for w in like) for j in range(3)]
        j = max(range(3), key=lambda j: alone[j])
        share, value = [float(k == j) for k in range(3)], alone[j]
        for k in (2, 3):
            now = [math.fsum(s * v for s, v in zip(share, w)) for w in like]
            gain = {j: math.fsum(math.log(max(a * (1 - 1 / k) + w[j] / k, 1e-26)) for a, w in zip(now, like)) for j in range(3) if not share[j]}
            allowed = {j for j in range(3) if share[j]} | {max(gain, key=lambda j: (gain[j], -j))}
            new = [1 / k if j in allowed else 0.0 for j in range(3)]
            for _ in range(langid.ROUNDS):
                r = [[s * v / max(math.fsum(a * b for a, b in zip(new, w)), 1e-300) for s, v in zip(new, w)] for w in like]
                new = [math.fsum(x[j] for x in r) / len(like) for j in range(3)]
            got = math.fsum(math.log(max(math.fsum(s * v for s, v in zip(new, w)), 1e-300)) for w in like) - (k - 1) * langid.PENALTY * math.log(len(like) + 1.0)
            if got <= value:
                break
            share, value = new, got
        return share

    got = langid.languages(spark.createDataFrame(rows, DOCS)).collect()
    assert len(got) == len(rows)
    for r, row in zip(sorted(got, key=lambda r: (r.doc_id, r.score)), sorted(rows, key=lambda r: r[0])):
        want = infer(row[1])
        assert r.lang_pred == langs[max(range(3), key=lambda j: want[j])] and r.score == pytest.approx(max(max(want), 1 / 3), abs=1e-6), r.doc_id
        assert dict(r.mixture) == pytest.approx({x: s for x, s in zip(langs, want) if s > 0.005}, abs=1e-6)


def test_op4_stated_and_mined_rules(spark):
    urls = [
        (1, "http://A.Example.ORG/es/x"), (2, "https://example.org/en/12"), (3, "https://example.org/en/2?q=/en/1"), (4, "http://x.com/fr/1#a"),
        (5, "http://x.com/de/"), (6, "http://notexample.org"), (7, None), (8, "example.org/es/"), (9, "http://y.net/es/3"), (10, "ftp://b.c//d://e"), (11, "http://org/"),
    ] + [(100 + k, f"http://h{k % 3}.example.org/es/{k}") for k in range(40)] + [(200 + k, f"http://h{k % 3}.com/fr/{k}") for k in range(40)]
    pages = spark.createDataFrame([(i, u, "x", "y") for i, u in urls], "page_id long, url string, host string, rule string")
    got = {r.page_id: r for r in url_rules.judged(pages).collect()}
    assert len(got) == len(urls)
    assert [(got[i].host, got[i].path, got[i].rule, got[i].verdict) for i in range(1, 6)] == [
        ("a.example.org", "/es/x", "example.org/es/", "block"), ("example.org", "/en/12", "example.org/en/1", "block"),
        ("example.org", "/en/2", "org/", "allow"), ("x.com", "/fr/1", "com/fr/", "allow"), ("x.com", "/de/", "com/de/", "block"),
    ]
    assert (got[6].host, got[6].path, got[6].rule) == ("notexample.org", "", None)
    assert [(got[i].host, got[i].path, got[i].rule) for i in (7, 8)] == [("", "", None)] * 2
    assert (got[10].host, got[10].path) == ("b.c", "//d://e")
    assert got[11].rule == "org/"
    assert (got[9].verdict, got[9].rule) == ("block", None) and "p=es" in got[9].mined_rule  # mined from the labelled urls
    assert url_rules.judged(pages.limit(0)).count() == 0


def test_op4_inverted_index_equals_set_inclusion(spark):
    rng = random.Random(6)
    sets = [tuple(sorted(rng.sample("abcdefgh", rng.randint(0, 6)))) for _ in range(60)]
    rules = [(tuple(sorted(rng.sample("abcdefgh", rng.randint(1, 3)))), rng.choice(["allow", "block"]), rng.randint(5, 9) / 10, 0.1) for _ in range(12)]
    rules = list({r[:2]: r for r in rules}.values())
    got = {tuple(r.tokens): (r.mined_rule, r.mined_verdict) for r in url_rules.best_rules(
        spark.createDataFrame([(list(s),) for s in set(sets)], "tokens array<string>"),
        spark.createDataFrame([(list(a), b, c, d) for a, b, c, d in rules], "rule_tokens array<string>, label string, confidence double, support double")).collect()}
    for s in set(sets):
        fits = [(c, d, len(a), " ".join(a), b) for a, b, c, d in rules if set(a) <= set(s)]
        assert got.get(s) == ((max(fits)[3], max(fits)[4]) if fits else None)


def test_op4_shared_segments_do_not_explode(spark):
    import itertools
    import time

    rng = random.Random(4)
    shared = "/".join(f"s{k}" for k in range(25))
    urls = [f"http://x.com/{rng.choice(['fr', 'de'])}/{shared}/{k}" for k in range(60)] + [f"http://y.net/{shared}/{k}" for k in range(3)] + ["http://y.net/s3", "http://y.net/q", None]
    pages = spark.createDataFrame(list(enumerate(urls + urls[:2])), "page_id long, url string")  # repeated rows
    began = time.time()
    got = url_rules.judged(pages).collect()
    assert time.time() - began < 60 and len(got) == len(urls) + 2
    assert all(r.rule == f"com/{u.split('/')[3]}/" for r, u in zip(sorted(got), urls[:60]))

    # verdicts and confidences equal plain set inclusion over all combinations of tokens
    words = "abcdefg"
    urls = []
    for k in range(150):
        some = [w for w in words if rng.random() < 0.5]
        some += ["t1", "t2"] if "a" in some else []  # always together
        urls.append(f"http://{rng.choice(['x.com', 'z.net'])}/{rng.choice(['fr', 'de'])}/" + "/".join(some))
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    base = url_rules.with_host_and_path(pages)
    tokens = {r.page_id: frozenset(r.t) for r in base.select("page_id", url_rules.tokens(F.col("url"), F.col("host"), F.col("path")).alias("t")).collect()}
    stated = {k: ("allow" if "/fr/" in u else "block") for k, u in enumerate(urls) if "x.com" in u}
    total, rules = len(stated), {}
    for n in range(1, 6):
        for some in itertools.combinations(sorted(set().union(*tokens.values())), n):
            fits = [label for k, label in stated.items() if set(some) <= tokens[k]]
            for label in ("allow", "block"):
                if fits.count(label) >= 0.05 * total and fits.count(label) / len(fits) >= 0.6:
                    rules[frozenset(some), label] = fits.count(label) / len(fits)
    got = {r.page_id: r for r in url_rules.judged(pages, support=0.05).collect()}
    for k in set(range(150)) - set(stated):
        best = max((c for (some, _), c in rules.items() if some <= tokens[k]), default=None)
        assert (got[k].confidence is None) == (best is None) and (best is None or got[k].confidence == pytest.approx(best)), urls[k]
        if best is not None:
            assert got[k].verdict in {label for (some, label), c in rules.items() if some <= tokens[k] and c == best}


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, before = [i] + [0] * len(b), row
        for j, y in enumerate(b, 1):
            row[j] = min(before[j] + 1, row[j - 1] + 1, before[j - 1] + (x != y))
    return row[-1]


def test_op5_automaton_equals_edit_distance():
    import numpy as np

    rng = random.Random(7)
    terms = [("moron", False), ("motor", False), ("bad", False), ("lowei", True), ("stupid", False), ("strié", False)]
    auto = toxicity.build_automaton(terms)
    words = [t for t, _ in terms]
    for _ in range(600):
        w = list(rng.choice(words) + rng.choice(["", "", "x", "ing"]))
        for _ in range(rng.randint(0, 2)):
            at = rng.randrange(len(w) + 1)
            w[at: at + rng.randint(0, 1)] = rng.choice(["", "o", "m", "z", "é"])
        words.append("".join(w) or "q")
    data = "".join(words).encode()
    cps, _ = toxicity.code_points(np.frombuffer(data, np.uint8), np.array([0, len(data)]))
    ends = np.cumsum([len(w) for w in words])
    state = auto.read(cps, ends - [len(w) for w in words], ends)
    for w, s in zip(words, state):
        assert auto.hit[s] == verdict(w, terms), w


def swapped_distance(a, b):
    """Edit distance with swaps of neighbours (each letter is edited once)."""
    d = [[max(i, j) if not i or not j else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
    for i, j in ((i, j) for i in range(1, len(a) + 1) for j in range(1, len(b) + 1)):
        d[i][j] = min(d[i - 1][j] + 1, d[i][j - 1] + 1, d[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
        if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
            d[i][j] = min(d[i][j], d[i - 2][j - 2] + 1)
    return d[-1][-1]


def verdict(w, terms):
    """0 none, 1 exact, 2 one edit, 3 a stem with one edit and a rest, by plain edit distances."""
    found = [0]
    for t, stem in terms:
        most = 1 if len(t) >= toxicity.FUZZY_FROM else 0
        near = swapped_distance(t, w)
        if near == 0 or (stem and w.startswith(t)):
            found.append(1)
        elif near <= most:
            found.append(2)
        elif stem and most and any(swapped_distance(t, w[:k]) <= 1 for k in range(len(w))):
            found.append(3)
    return min([f for f in found if f], default=0)


def test_op5_misspelt_stems_and_swaps():
    import numpy as np

    terms = [("moron", True), ("idiot", False), ("idiots", False), ("bad", True), ("stupid", True)]
    auto = toxicity.build_automaton(terms)
    rng = random.Random(3)
    words = "m0rons m0ronic idoit id1ots moron morons mroon mroonic bda badly batly stupdi stpuidly st dumb idiotz odiit onrom".split()
    for _ in range(1500):
        w = list(rng.choice(terms)[0] + rng.choice(["", "", "s", "ic", "ion"]))
        for _ in range(rng.randint(0, 2)):
            i = rng.randrange(len(w))
            if rng.random() < 0.4 and i + 1 < len(w):
                w[i], w[i + 1] = w[i + 1], w[i]
            else:
                w[i: i + rng.randint(0, 1)] = rng.choice(["", "o", "m", "z", "t"])
            w = w or ["q"]
        words.append("".join(w))
    data = "".join(words).encode()
    cps, _ = toxicity.code_points(np.frombuffer(data, np.uint8), np.array([0, len(data)]))
    ends = np.cumsum([len(w) for w in words])
    state = auto.read(cps, ends - [len(w) for w in words], ends)
    got = auto.hit[state].tolist()
    assert dict(zip(words, got)) == {w: verdict(w, terms) for w in words}
    assert all(g > 0 for w, g in list(zip(words, got))[:9] if w != "bda")


def test_op5_rare_and_long_terms(spark):
    """Terms of twelve texts each (2.5% of the toxic ones), some of more than 24 letters, and their misspellings in texts that the model has not seen."""
    rng = random.Random(21)
    terms = ["".join(rng.choices("bcdfghjklmnpqrstvwz", k=n)) for n in [7, 8, 9, 10, 11, 12, 30, 40] * 5]
    rows, marks = [], []
    for i in range(2400):
        toxic = i % 5 == 0
        text = prose(rng, 60).split()
        if toxic:
            text.insert(rng.randrange(60), terms[i // 5 % len(terms)])
        rows.append((i, " ".join(text)))
        marks.append((i, 1, int(toxic)))
    wrong = {}
    for k, t in enumerate(terms):
        w = list(t)
        at = rng.randrange(1, len(w) - 2)
        if k % 2:
            w[at], w[at + 1] = w[at + 1], w[at]
        else:
            w[at] = "0"
        wrong[5000 + k] = " ".join(prose(rng, 40).split() + ["".join(w)] + prose(rng, 20).split())
    clean = {6000 + k: prose(rng, 60) for k in range(100)}
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    got = {r.doc_id: r.predicted for r in toxicity.toxicity_scores(frame(spark, rows + list(wrong.items()) + list(clean.items())), labels).collect()}
    assert sum(got[i] for i in wrong) >= 0.95 * len(wrong) and sum(got[i] for i in clean) <= 1
    assert sum(got[i] != int(i % 5 == 0) for i, _ in rows) <= 5


def test_op5_terms_of_all_scripts_match():
    import numpy as np

    auto = toxicity.build_automaton([("馬鹿", False), ("ばかやろう", False), ("moron", False)])
    data = "馬鹿。とても、ばかやろx 馬車 moron 𝒳y".encode()
    cps, bounds = toxicity.code_points(np.frombuffer(data, np.uint8), np.array([0, len(data)]))
    start, end = toxicity.word_runs(cps, bounds)
    words = ["".join(map(chr, cps[a:b])) for a, b in zip(start, end)]
    assert words == ["馬鹿", "とても", "ばかやろx", "馬車", "moron", "𝒳y"]
    assert auto.hit[auto.read(cps, start, end)].tolist() == [1, 0, 2, 0, 1, 0]


def labelled(spark, rng, n=400):
    rows, marks = [], []
    for i in range(n):
        w = prose(rng, rng.randint(10, 60)).split()
        toxic, good = i % 5 == 0, i % 7 != 0
        if toxic:
            for _ in range(rng.randint(1, 3)):
                w[rng.randrange(len(w))] = rng.choice(["gorfnak", "blenchy", "zurpit", "hoovadden"])
        if not good:
            w = [x.upper() + "!!" for x in w]
        rows.append((i, " ".join(w)))
        marks.append((i, int(good), int(toxic), "z"))
    return rows, spark.createDataFrame(marks + [(None, 1, 1, ""), (5, None, None, "")], "doc_id long, quality int, toxic int, text string")


def test_op5_finds_toxic_texts_and_their_misspellings(spark, none):
    rng = random.Random(11)
    rows, labels = labelled(spark, rng)
    extra = [(1000, "ka lo gorfnaq mi ren tas"), (1001, 'he said "gorfnak" to me'), (1002, None), (1003, "")]
    got = {r.doc_id: r for r in toxicity.toxicity_scores(frame(spark, rows + extra), labels).collect()}
    truth = {i: int(i % 5 == 0) for i, _ in rows}
    wrong = [i for i in truth if got[i].predicted != truth[i]]
    assert len(wrong) <= 2
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i in got)
    assert got[1000].score > got[1002].score and got[1001].score < got[0].score
    assert got[1002].score == got[1003].score < 0.5
    kept = toxicity.without_toxic(frame(spark, rows), labels)
    assert kept.columns == none.columns and {r.doc_id for r in kept.collect()} == {i for i in truth if not got[i].predicted}
    assert toxicity.toxicity_scores(none, labels).count() == 0
    assert {r.score for r in toxicity.toxicity_scores(frame(spark, rows[:3]), labels.limit(0)).collect()} == {0.0}


def test_op8_quality(spark, none):
    rng = random.Random(12)
    rows, labels = labelled(spark, rng)
    got = {r.doc_id: r for r in quality.quality_scores(frame(spark, rows + [(1002, None), (1003, "")]), labels).collect()}
    wrong = [i for i, _ in rows if got[i].predicted != int(i % 7 != 0)]
    assert len(wrong) <= 4
    assert got[1002].score == got[1003].score and 0 <= got[1002].score <= 1
    kept = quality.good_only(frame(spark, rows), labels)
    assert kept.columns == none.columns and {r.doc_id for r in kept.collect()} == {i for i, _ in rows if got[i].predicted}
    assert quality.quality_scores(none, labels).count() == 0
    assert {r.score for r in quality.quality_scores(frame(spark, rows[:3]), labels.limit(0)).collect()} == {0.5}


def test_op8_context_vectors_match_a_plain_sum(docs):
    import numpy as np

    index = quality.index_vectors().astype(float)
    total = np.zeros((quality.FORMS, quality.DIMS))
    import pyarrow as pa

    for _, t in corpus():
        data, offsets = textnum.buffer_of(pa.array([t], pa.string()))
        w = textnum.words_of(data, offsets, textnum.NON_SPACE)
        f = quality.forms_of(data, w) if len(w.hash) else []
        for i, x in enumerate(f):
            for j in range(max(0, i - quality.REACH), min(len(f), i + quality.REACH + 1)):
                if j != i:
                    total[x] += index[f[j]]
    total += index
    want = total / np.maximum(np.linalg.norm(total, axis=1, keepdims=True), 1e-9)
    assert np.allclose(quality.form_vectors(docs), want, atol=1e-5)


PAGE = '<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p>";</script></head><body><nav><ul><li><a href="/x">home page</a></li></ul></nav><div class="ad">buy this now</div>%s<footer>&copy; me and you</footer></body></html>'


def test_op9_main_text(spark):
    body = "<article><h1>Big  title</h1><p><b>First &amp; foremost\n words<br>here<p>Second <i>par</i>t, caf&eacute;.</p></article>"
    rows = [(i, f"u{i}", PAGE % body) for i in range(30)] + [
        (100, "v", PAGE % "<article><p>one two</p><aside>side bar</aside><div class='comments'><p>reader says</p></div><form>name <input></form><p>three</p></article>"),
        (101, "v", PAGE % "<div id=content><h2>No article</h2><p>but many words of text here</p><div class='ad x'>advert</div><p>end</p></div>"),
        (102, None, None), (103, "e", ""), (104, "e", "plain words"), (105, "e", "<p>cut off &lt;tag&gt; <art"), (106, "e", (PAGE % body)[:-40]),
    ]
    pages = spark.createDataFrame([(*r, "t") for r in rows], "page_id long, url string, html string, text string")
    got = {r.page_id: r for r in extract.main_texts(pages).collect()}
    full = "Big title First & foremost words here Second part, café."
    assert got[0].text == got[106].text == full and got[0].n_chars == len(full)
    assert [got[i].text for i in range(100, 106)] == ["one two three", "No article but many words of text here end", "", "", "plain words", "cut off <tag>"]
    assert extract.main_texts(pages.limit(0)).count() == 0


def test_op9_the_run_decides_beside_articles(spark):
    told = " ".join(f"word{i}" for i in range(60))
    rows = [(i, "u", PAGE % f"<article><p>{told}</p></article>") for i in range(30)] + [
        (100, "v", PAGE % f"<div class=story><h2>Head</h2><p>{told}</p></div><ul><li>link</li></ul><article class=card><p>a small teaser</p></article>"),
        (101, "v", PAGE % "<article><p>first part</p></article><article><p>second part</p></article><article><p>third part</p></article>"),
        (102, "v", PAGE % f"<div class=story><h2>Head</h2><p>{told}</p></div>"),
    ]
    got = {r.page_id: r.text for r in extract.main_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[0] == told and got[100] == got[102] == f"Head {told}"
    assert got[101] == "first part second part third part"


def test_op9_open_and_self_closed_elements():
    for source, want in [
        ("<article><p>One <svg/> two three", "One two three"),
        ("<article>a <svg><path d=x/><text>no</text></svg> b <math/> c <math><mi>x</mi></math> <object>d</object></article>", "a b c x d"),
        ("<article>a <button>b c<p> d <noscript>e <select><option> f<p> g</article>", "a b c d e f g"),
        ("<article>a <button>b</button> <noscript>c<div>d</noscript> <select><option>e<option>f</select> <iframe/>g</article>", "a g"),
        ("<html><head><title>T</title><meta a=b><body><p>all the text", "all the text"),
        ("<html><head><title>T<p>all the text", "all the text"),
        ("<head><title>T</title> all <i>the</i> text", "all the text"),
        ("<head><noscript><img src=x></noscript><title>T</title></head><p>all the text", "all the text"),
        ("<article>a <script>b</article>", "a"),
    ]:
        page = extract.Page(source)
        assert " ".join("".join(x[2] for x in page.items).split()) == want, source


def test_op9_learned_weights_overrule_the_lists(spark):
    """List and weights disagree: a name of the list that labelled pages have inside, and one outside that no list has."""
    told = " ".join(f"word{i}" for i in range(40))
    more = "Engines answer queries from an index. " * 6
    body = f"<article><p>{told}</p><section class=newsletter><p>{told}</p></section><div class=zzz><p>{told}</p></div></article>"
    rows = [(i, "u", f"<body><div class=zzz>ten words of some kind or other stand here now</div><article><p>{told}</p></article>") for i in range(40)]
    weights = extract.learn(spark.createDataFrame(rows, "page_id long, url string, html string"))
    assert "div.zzz" in weights.known and "section.newsletter" not in weights.known
    assert "div.zzz" in weights.out and weights.main_text(body) == told
    weights = extract.Weights([(True, "article", 900, 1), (True, "section.newsletter", 500, 1), (True, "div.zzz", 1, 900), (False, "section.newsletter", 9, 1)])
    assert weights.main_text(body) == f"{told} {told}"
    # pages wrapped in one form, and article sections with a name of the list, keep their text
    weights = extract.Weights([(True, "article", 900, 1)])
    assert weights.main_text(f"<form id=aspnetForm><nav>menu</nav><article><p>{more}</p></article></form>") == more.strip()
    assert weights.main_text(f"<article><p>{told}</p><section class=search><p>{more}</p></section><div class=search>find <input></div><div class=comments><p>{more}</p></div></article>") == f"{told} {more.strip()}"


def test_op9_deep_nesting_takes_linear_time():
    import time

    weights = extract.Weights([(True, "div", 5, 1)])
    source = "<div>a</x>" * 7200 + "text </p></article>" * 200
    began = time.time()
    text = weights.main_text(source)
    assert time.time() - began < 1.0 and text.count("text") == 200


def test_op9_ties_repeats_and_long_pages(spark):
    weights = extract.Weights([(True, "page", 50, 1), (False, "hr", 1, 900), (False, "p", 1, 1)])
    page = extract.Page("a b<hr><hr>c d")
    assert weights.region(page) == (0, 1)  # the first of equals
    long = "word " * 300_000
    rows = [(1, "u", f"<article><p>{long}</p></article>"), (1, "u", f"<article><p>{long}</p></article>"), (2, "v", "<p>x</p>"), (2, "v", "<p>x</p>")]
    got = extract.main_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert sorted((r.page_id, r.text == long.strip(), r.n_chars) for r in got) == [(1, True, 1_499_999)] * 2 + [(2, False, 1)] * 2


def test_op9_region_is_the_best_run():
    rng = random.Random(1)
    weights = extract.Weights([(True, "page", 50, 1), (False, "p", 1, 5), (False, "u", 3, 1)])
    for _ in range(100):
        source = "".join(rng.choice(["<p>", "<u>", "a b ", "c "]) for _ in range(rng.randint(0, 14)))
        page = extract.Page(source)
        score = [len(x[2].split()) * weights.word["page"] if x[0] else weights.tag.get(x[1], extract.NEW_TAG) for x in page.items]
        best = max([0.0] + [sum(score[a:b]) for a in range(len(score)) for b in range(a + 1, len(score) + 1)])
        a, b = weights.region(page)
        assert sum(score[a:b]) == pytest.approx(best)


def test_pipeline_odd_rows_and_empty_tables(spark, tmp_path):
    import corpus_pipeline

    rng = random.Random(17)
    rows, labels = labelled(spark, rng, 150)
    odd = [(5000, None), (5001, ""), (5002, " \n"), (5003, prose(rng, 30_000)), (None, "no id here"), (None, None), (5004, rows[1][1]), (5005, rows[1][1]), (5004, rows[1][1])]
    item = prose(rng, 20)

    def write(at, docs, labels, items):
        frame(spark, docs).write.parquet(f"{at}/documents.parquet")  # with columns score, kept, node
        labels.select("doc_id", "quality", "toxic").write.parquet(f"{at}/labels.parquet")
        spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{at}/benchmark.parquet")

    sf = str(tmp_path / "odd")
    write(sf, rows + odd, labels, [(1, item), (2, None), (3, "")])
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf).cache()
        assert docs.columns == DOCS.replace(",", "").split()[::2], name
    ids = [r.doc_id for r in docs.collect()]
    assert ids.count(5004) + ids.count(5005) + ids.count(1) <= 1 and len(ids) == len(set(ids) - {None}) + ids.count(None)
    packed = corpus_pipeline.run(spark, sf).collect()
    assert {r.doc_id for r in packed} == set(ids) and sum(r.length for r in packed if r.doc_id == 5003) > 2048

    none = str(tmp_path / "none")
    write(none, [], labels.limit(0), [])
    assert corpus_pipeline.run(spark, none).count() == 0
    unlabelled = str(tmp_path / "unlabelled")
    write(unlabelled, rows[:20], labels.limit(0), [])
    assert {r.doc_id for r in corpus_pipeline.run(spark, unlabelled).collect()} == {i for i, _ in rows[:20]}


def test_pipeline_stages(spark, tmp_path):
    """The pipeline against its operators' brute-force counterparts on a small corpus."""
    import corpus_pipeline

    rng = random.Random(13)
    rows, labels = labelled(spark, rng, 300)
    copies = [(2000 + k, rows[k][1]) for k in (1, 2, 3)]
    item = prose(rng, 20)
    leaked = [(3000, rows[4][1] + " " + item)]
    sf = str(tmp_path)
    frame(spark, rows + copies + leaked).select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"{sf}/documents.parquet")
    labels.select("doc_id", "quality", "toxic").write.parquet(f"{sf}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "quality", "near_dedup", "decontamination", "packing"]
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, ids = docs.columns, None
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf).cache()
        assert docs.columns == columns, name
    ids = {r.doc_id for r in docs.collect()}
    good = {i for i, _ in rows if i % 5 and i % 7}
    assert len(ids ^ good) <= 3 and not ids & {2001, 2002, 2003, 3000}
    assert {r.doc_id for r in corpus_pipeline.run(spark, sf).collect()} == ids
    assert corpus_pipeline.ORACLE_SQL is None


def test_components_are_written_in_few_files(spark):
    """Each file of a local file system costs the executor a process; small tables need one for each task slot at most."""
    edges = spark.createDataFrame([(10 * i + j + 1, 10 * i + j) for i in range(300) for j in range(9)], "a long, b long")
    told = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in told}
    try:
        for k, v in told.items():
            spark.conf.set(k, v)
        found = neardup.components(edges)
        assert len(found.inputFiles()) <= spark.sparkContext.defaultParallelism
        assert {r.node: r.comp for r in found.collect()} == {10 * i + j: 10 * i for i in range(300) for j in range(10)}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_pair_checks_hold_one_python_worker_a_task(spark):
    texts = [(i, " ".join(f"w{(7 * i * j) % 11}x{j}" for j in range(40))) for i in range(1, 4)] + [(4, " ".join(f"w{(7 * j) % 11}x{j}" for j in range(40)))]
    docs = staged(spark.createDataFrame(texts, "doc_id long, text string"), "t_docs")
    nodes = staged(neardup.signatures(docs).withColumnRenamed("doc_id", "node"), "t_nodes")
    pairs = staged(spark.createDataFrame([(4, 1), (4, 2), (3, 2)], "a long, b long"), "t_pairs")
    near = neardup.colliding(pairs, nodes)
    assert near._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1
    sure = neardup.confirmed(pairs, docs)
    assert "BroadcastHashJoin" not in sure._jdf.queryExecution().executedPlan().toString()
    assert {(r.a, r.b) for r in near.collect()} == {(r.a, r.b) for r in sure.collect()} == {(4, 1)}


def test_known_chunks_take_few_bytes():
    coder = packing.ChunkEncoder(packing.tokenizer_path())
    texts = [" ".join(f"word{i * j} Other-{j}" for j in range(i % 7, 200)) for i in range(60)]
    for part in (texts[:20], texts[10:50], texts[::-1]):
        got = [ids.tolist() for ids in coder.texts(*textnum.buffer_of(pa.array(part)))]
        assert got == [coder.tokenizer.encode(t, add_special_tokens=False).ids for t in part]
    assert len(coder.known) > 1000 and coder.known.nbytes + coder.slot.nbytes == 16 * len(coder.known)
