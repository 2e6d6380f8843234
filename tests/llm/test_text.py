"""License scans, personal data, fingerprints, tokens and mixes against plain Python."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from skylag.llm import disclosure, fingerprints, licenses, mixing, sentencepiece_matching

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def rows(llm):
    return sorted(llm.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "source").collect())


# --- license scans

def test_phrases_equal_brute_force(llm):
    texts = ["MIT license, mit LICENSE", "mit. license", "general public license mit license", "mit x license",
             "the apache", "license apache license", "", "ümit license", "general public\nlicense"] * 3
    docs = llm.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    for r in licenses.scan(docs).collect():
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", texts[r.doc_id].lower())
        places, labels = [], set()
        for phrase, label in licenses.PHRASES.items():
            p = phrase.split()
            found = [i for i in range(len(words)) if words[i : i + len(p)] == p]
            places += found
            labels |= {label} if found else set()
        assert (r.n_words, r.n_base) == (len(words), len(places))
        assert (r.first_word, r.last_word) == ((min(places), max(places)) if places else (None, None))
        assert r.base_labels == ",".join(sorted(labels)) and labels <= set(r.labels.split(",")) | {""}


def test_templates_are_found_with_edits_and_without_their_name(llm):
    grant = licenses.TEMPLATES[1][1]
    words = grant.split()
    changed = " ".join(w for i, w in enumerate(words) if i not in (7, 20, 33)).replace("furnished", "given")
    filler = " ".join(f"word{i}" for i in range(300))
    texts = [f"{filler} {grant} {filler}", f"{filler} {changed}", " ".join(words[:20]), filler, f"{grant} {filler} {changed}"]
    docs = llm.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in licenses.scan(docs).collect()}
    assert [got[i].labels for i in range(5)] == ["mit", "mit", "", "", "mit"]
    assert [got[i].n_base for i in range(5)] == [0] * 5
    assert [got[i].n_spans for i in range(5)] == [1, 1, 0, 0, 2]
    assert got[0].score == 1.0 and 0.9 < got[1].score < 1.0 and got[3].score == 0.0


# --- personal data

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain_spans(text):
    def digits(m):
        return re.sub(r"[^0-9]", "", m.group())

    out = [("email", *m.span()) for m in EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
    out += [("card", *m.span()) for m in CARD.finditer(text) if 13 <= len(digits(m)) <= 19 and disclosure.luhn(digits(m))]
    return out + [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(digits(m)) <= 15]


def test_base_spans_equal_the_plain_patterns(rows):
    rng = random.Random(7)
    pieces = ["a", "@", ".", "b-", "1", "22", "255", "256", " ", "-", "+", "(", ")", "4111111111111111", "ü", "%"]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 40))) for _ in range(4000)]
    texts += ["0" * 25 + "1.2.3.4", "a@b@c.d", "x.@y.z.w", "1" * 30000, "a" * 30000 + "@", "+" * 3000 + "1 (2) 3456 7890-"]
    for text in texts + [r.text for r in rows]:
        assert disclosure.personal_spans(text) == plain_spans(text), text[:80]


def test_terms_that_give_an_entity_away(llm):
    rng = random.Random(3)
    common = [f"{a}{b}{c}" for a in "bcdfgh" for b in "aeiou" for c in "lmnrst"]

    def words(n):
        return " ".join(rng.choice(common) for _ in range(n))

    texts = [f"{words(30)} Zweistein wrote from zw@lab.example.org {words(30)}" for _ in range(6)]
    texts += [f"{words(20)} Zweistein {words(20)}"] + [words(60) for _ in range(200)]
    texts += [f"{words(30)} mail x{i}@b.example.org {words(5)}" for i in range(20)]
    docs = llm.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    clean = {r.doc_id: r.text for r in disclosure.sanitised(docs).collect()}
    assert all("Zweistein" not in clean[i] and "zw@" not in clean[i] for i in range(7))
    assert all(clean[i] == texts[i] for i in range(7, 207))
    assert all(clean[i] == re.sub(EMAIL, "[email]", texts[i]) for i in range(207, 227))
    assert disclosure.replace_spans("Ab c@d.e x", [("email", 3, 8), ("generalise", 0, 2)]) == "[Name] [email] x"


# --- fingerprints

def _prose(seed, n):
    rng = random.Random(seed)
    return " ".join("".join(rng.choices("abcdefghijklmnop", k=rng.randint(3, 9))) for _ in range(n))


def test_a_passage_of_a_long_text_keeps_anchors():
    passage, before, after = _prose(1, 1_500), _prose(2, 70_000), _prose(3, 70_000)
    (one, places), (two, _) = fingerprints.anchors_of([before + passage + after, after + passage + before])
    inside = (places > len(before)) & (places < len(before) + len(passage) - fingerprints.K)
    # one anchor for 64 to 76 bytes in the mean
    assert inside.sum() > len(passage) / 140
    assert set(one[inside].tolist()) <= set(two.tolist())


@pytest.mark.parametrize("words", [600, 20_000])
def test_insertions_leave_near_copies_alike(words):
    text = _prose(4, words).split()
    two = text[: words // 3] + _prose(5, 12).split() + text[words // 3 : words * 2 // 3] + _prose(6, 15).split() + text[words * 2 // 3 :]
    drift = [w for i, w in enumerate(text) for w in ([w, "extra"] if i % 40 == 7 else [w])]
    parts = [text[i : i + words // 60] for i in range(0, words, words // 60)]
    mixed = random.Random(7).sample(parts, len(parts))
    a, b, c, d, e = fingerprints.anchors_of([" ".join(x) for x in (text, two, drift, sum(mixed, []), _prose(8, words).split())])
    assert fingerprints.likeness(a, a) == 1
    assert fingerprints.likeness(a, b) > 0.8 and fingerprints.likeness(b, a) == fingerprints.likeness(a, b)
    assert fingerprints.likeness(a, c) > 0.6
    assert fingerprints.likeness(a, d) < 0.4 and fingerprints.likeness(a, e) == 0


def test_texts_of_unlike_length_are_compared_where_both_are_known():
    long, short = _prose(9, 5_000), _prose(10, 300)
    a, b = fingerprints.anchors_of([long, long[: len(long) // 2]])
    assert abs(fingerprints.likeness(a, b) - 0.5) < 0.1
    c, d = fingerprints.anchors_of([short, short + " " + _prose(11, 700)])
    assert abs(fingerprints.likeness(c, d) - 0.3) < 0.2


def test_fingerprints_equal_plain_order(llm, rows):
    docs = llm.read.parquet(f"{SF}/documents.parquet").repartition(5)
    got = {r.doc_id: r for r in fingerprints.fingerprints(docs).collect()}
    for r, after in zip(rows, rows[1:] + rows[:1]):
        half, mine = len(r.text) // 2, got[r.doc_id]
        changed = r.text[: len(r.text) - half] + after.text[:half]
        a, e, n = fingerprints.anchors_of([r.text, changed, after.text])
        assert mine.n_chars == len(r.text) and mine.edited_sha256 == fingerprints._sha(changed)
        assert (mine.fingerprint, mine.edited_fingerprint) == (fingerprints.written_out(a), fingerprints.written_out(e))
        assert (mine.near_edited, mine.near_next) == (fingerprints.likeness(a, e), fingerprints.likeness(a, n))
    texts = Counter(r.text for r in rows)
    prints = {}
    for r in rows:
        assert prints.setdefault(r.text, got[r.doc_id].fingerprint) == got[r.doc_id].fingerprint
    assert np.mean([got[r.doc_id].near_edited for r in rows]) > 0.25
    assert np.mean([got[r.doc_id].near_next for r in rows if texts[r.text] == 1]) < 0.05


def test_syncmers_equal_their_definition_and_ignore_their_surroundings():
    rng = random.Random(5)
    data = np.array([rng.randrange(97, 105) for _ in range(3000)], np.uint8)
    at, hashes = fingerprints.syncmers(data, np.array([0, 1200, 3000]))
    value = data.astype(np.uint64)
    inner = {}
    for i in range(len(data) - fingerprints.S + 1):
        x = sum(int(data[i + j]) << (8 * j) for j in range(fingerprints.S))
        inner[i] = int(fingerprints.mixed(np.array([x], np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1))[0])
    expected = []
    for a, b in ((0, 1200), (1200, 3000)):
        for i in range(a, b - fingerprints.K + 1):
            window = [inner[i + j] for j in range(fingerprints._WINDOW)]
            if min(window) in (window[0], window[-1]):
                expected.append(i)
    assert at.tolist() == expected and len(value) == 3000
    alone, same = fingerprints.syncmers(data[500:900].copy(), np.array([0, 400]))
    inside = (at >= 500) & (at <= 900 - fingerprints.K)
    assert (alone + 500).tolist() == at[inside].tolist() and (same == hashes[inside]).all()


# --- tokens

def test_ids_equal_the_library_and_come_back(llm, rows):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=sentencepiece_matching.MODEL)
    rng = random.Random(9)
    signs = "aabcthe  \n\t\réü日本€.,!?0129\U0001F600\x00ſ▁"
    texts = [r.text for r in rows] + ["".join(rng.choice(signs) for _ in range(rng.randint(0, 80))) for _ in range(800)]
    texts += ["", " ", "   x", "x   ", "z" * 3000, "the" * 900, "a b" * 500]
    docs = llm.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    encoded = sentencepiece_matching.encode(docs, check="back")
    got = {r.doc_id: r for r in encoded.collect()}
    assert all(got[i].token_ids == model.encode(t) for i, t in enumerate(texts))
    assert all(got[i].back == ("▁" not in t) for i, t in enumerate(texts))
    decoded = {r.doc_id: r.text for r in sentencepiece_matching.decode(encoded.drop("text")).collect()}
    assert all(decoded[i] == t.replace("▁", " ") for i, t in enumerate(texts))


def test_small_arrays_give_the_same_ids(monkeypatch, rows):
    vocabulary = sentencepiece_matching.Vocabulary(sentencepiece_matching.load_pieces())
    texts = [r.text for r in rows[:40]]
    whole = sentencepiece_matching.Encoder(vocabulary).encode(texts)
    monkeypatch.setattr(sentencepiece_matching, "ARRAY_CHARS", 50)
    monkeypatch.setattr(sentencepiece_matching, "REMEMBERED", 100)
    encoder = sentencepiece_matching.Encoder(vocabulary)
    parts = [encoder.encode(texts[i : i + 7])[0] for i in range(0, 40, 7)]
    assert np.concatenate(parts).tolist() == whole[0].tolist()


# --- mixes

def test_budgets_are_filled_exactly():
    rng = random.Random(2)
    for _ in range(300):
        lengths = rng.sample(range(1, 60), rng.randint(1, 12))
        counts = [rng.randint(1, 5) for _ in lengths]
        total = sum(n * c for n, c in zip(lengths, counts))
        sums = {0}
        for n, c in zip(lengths, counts):
            sums = {s + n * k for s in sums for k in range(c + 1)}
        budget = rng.randint(0, total + 5)
        for exact in (1 << 17, 100):
            taken = mixing.fill_budget(lengths, counts, budget, exact)
            got = int((np.array(lengths) * taken).sum())
            assert (taken <= counts).all() and (taken >= 0).all()
            if exact > total:
                assert got == max(s for s in sums if s <= budget)
            else:
                assert got <= budget


def test_a_large_budget_is_filled_in_proportion():
    lengths = np.arange(1, 2000)
    counts = np.full(len(lengths), 1000)
    budget = int((lengths * counts).sum()) // 3
    taken = mixing.fill_budget(lengths, counts, budget)
    assert (lengths * taken).sum() == budget and abs(taken[:500].sum() - 500_000 / 3) < 20_000


def test_mix_follows_its_targets(llm, rows):
    docs = llm.read.parquet(f"{SF}/documents.parquet")
    got = mixing.mix(docs).collect()
    again = mixing.mix(docs.repartition(7)).collect()
    assert sorted(got) == sorted(again)
    size = {r.doc_id: len(re.findall(r"[^\x20\x09-\x0D]+", r.text)) for r in rows}
    source = {r.doc_id: r.source for r in rows}
    total, taken, target = Counter(), Counter(), {}
    for r in got:
        s = source[r.doc_id]
        assert r.size == size[r.doc_id] and r.taken % max(r.size, 1) == 0 and 0 <= r.taken <= 2 * r.size
        total[s] += r.size
        taken[s] += r.taken
        target[s] = r.target
        assert abs(r.taken - r.copies * r.size) == 0
    weight = dict(zip(sorted(total), [3, 1, 2] * len(total)))
    goal = 1.5 * sum(total.values())
    assert abs(sum(target.values()) - goal) < 1e-6 * goal
    open_ones = [s for s in total if target[s] < 2 * total[s] - 1e-9]
    assert all(target[s] <= 2 * total[s] for s in total)
    rates = {round(target[s] / weight[s], 6) for s in open_ones}
    assert len(rates) == 1 and all(2 * total[s] <= weight[s] * max(rates) + 1e-6 for s in total if s not in open_ones)
    # a few documents of one source cannot make up every sum
    assert all(abs(taken[s] - target[s]) <= max(40, 0.02 * target[s]) for s in total)


def test_a_hot_length_is_split(llm):
    docs = llm.range(5000).selectExpr("id AS doc_id", "'same text of five words' AS text", "'one' AS source")
    got = mixing.mix(docs).collect()
    assert sum(r.taken for r in got) == 37_500 and Counter(r.copies for r in got) == {1: 2500, 2: 2500}
