"""The secret scan: base patterns and decoding against brute force, held-out secrets, edge cases."""

import hashlib
import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from skylag.llm import secret_scan as S

from .conftest import TEXTS

_ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A)
_ACCESS, _HEX = re.compile(r"AKIA[A-Z0-9]+"), re.compile(r"[0-9a-f]+")


def plain_base(text):
    out = [("assign", m) for m in _ASSIGN.finditer(text) if len(m.group(2)) >= 6]
    out += [("access", m) for m in _ACCESS.finditer(text) if len(m.group()) >= 20]
    out += [("hex", m) for m in _HEX.finditer(text) if len(m.group()) >= 24]
    return sorted(((m.start(), S.KINDS.index(k), m.end()) for k, m in out))


PIECES = ["token", "Token=", "SECRET : 'abc", "passwd", "api_key=", "apikey:", " ", "\n", '"', "=", "AKIA", "AKIA" + "Q7" * 9,
          "0123456789abcdef" * 2, "deadbeef", "é", "ſecret=abcdefg", "toKen=abcdefg", "x", "password=hunter2!", "\U0001F600", "secret=token: longenough"]


def texts_of_pieces(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choices(PIECES, k=rng.randrange(12))) for _ in range(n)]


def test_base_patterns_are_those_of_the_contract(llm):
    texts = [*texts_of_pieces(400, 1), None]
    df = llm.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.spans for r in S.secrets(df).collect()}
    for i, text in enumerate(texts):
        mine = [(s.start, S.KINDS.index(s.kind), s.end) for s in got[i] if s.kind != "tagged"]
        assert mine == plain_base(text or ""), text
        # what is added touches no base span
        for s in got[i]:
            if s.kind == "tagged":
                assert not any(a < s.end and s.start < b for a, _, b in mine)
        assert [(s.start, S.KINDS.index(s.kind)) for s in got[i]] == sorted((s.start, S.KINDS.index(s.kind)) for s in got[i])


def test_tokens_are_words_and_single_signs():
    data, offsets = S.utf8(__import__("pyarrow").array(["ab=«é1", None, "c--", "d"]))
    starts, ends = S.tokens(data, offsets)
    assert [bytes(data[a:b]).decode() for a, b in zip(starts, ends)] == ["ab", "=", "«é1", "c", "-", "-", "d"]


@pytest.mark.parametrize("piece", [1, 2, 3, 128])
def test_decoding_finds_the_best_of_all_tag_sequences(piece):
    rng = np.random.default_rng(piece)
    tagger = S.Tagger(after=rng.normal(size=(3, 3)), first=rng.normal(size=3)).rounded()
    chains = [np.round(rng.normal(size=(n, 3)) * 64) / 64 for n in (1, 4, 6, 2, 5)]
    begins = np.concatenate([np.arange(len(c)) == 0 for c in chains])
    got = S.viterbi(np.concatenate(chains), begins, tagger, piece)
    at = 0
    for chain in chains:
        def score(tags):
            total = tagger.first[tags[0]] + sum(chain[i, t] for i, t in enumerate(tags))
            return total + sum(tagger.after[a, b] for a, b in zip(tags, tags[1:]))

        best = max(itertools.product(range(3), repeat=len(chain)), key=score)
        assert score(tuple(got[at : at + len(chain)])) == score(best)
        at += len(chain)
    assert len(S.viterbi(np.zeros((0, 3)), np.zeros(0, bool), tagger)) == 0


def test_a_fit_makes_given_tags_likely():
    rng = np.random.default_rng(4)
    index = rng.integers(0, 5, (200, 9, 2)) + [0, 10]
    tags = np.where(index[:, :, 0] == 3, S.BEGIN, S.OUTSIDE).astype(np.int8)
    tags[:, 1:][(index[:, :-1, 0] == 3) & (tags[:, 1:] == S.OUTSIDE)] = S.INSIDE
    used = rng.integers(1, 10, 200)
    tagger = S.fit(index.astype(np.int32), tags, used, epochs=40, batch=50)
    hit = total = 0
    for x, y, m in zip(index, tags, used):
        got = S.viterbi(tagger.emissions(x[:m].T), np.arange(m) == 0, tagger)
        hit, total = hit + (got == y[:m]).sum(), total + m
    assert hit / total > 0.98


def corpus(n, seed, secret=True):
    """Ordinary lines with numbers, addresses and dates; every third has a base secret."""
    rng = random.Random(seed)
    words = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randrange(2, 9))) for _ in range(300)]
    out = []
    for i in range(n):
        body = [rng.choice(words) + rng.choice(("", "", ",", ".", "\n")) for _ in range(rng.randrange(20, 80))]
        body.insert(5, rng.choice((f"{rng.randrange(10**6)}", "mail@site.org", "2024-05-06", "+49 30 1234567", "count = 17")))
        if secret and i % 3 == 0:
            body.insert(12, f'token = "{hashlib.sha1(str((seed, i)).encode()).hexdigest()}"')
        out.append(" ".join(body))
    return out


def test_unseen_kinds_of_secrets_are_found_and_clean_texts_left_alone(llm):
    rng = random.Random(5)
    known, clean = corpus(300, 1), corpus(200, 2, secret=False)
    planted = []
    for text in corpus(60, 3, secret=False):
        cut = text.index(" ", len(text) // 2) + 1
        value = "ghx_" + "".join(rng.choices(S._LETTERS, k=34))
        planted.append((text[:cut] + f'passphrase: "{value}" ' + text[cut:], value))
    def table(rows):
        return llm.createDataFrame(list(enumerate(rows)), "doc_id long, text string").repartition(4)

    tagger = S.train(table(known), F.col("text"))
    got = {r.doc_id: r.spans for r in S.secrets(table([*clean, *(t for t, _ in planted)]), tagger=tagger).collect()}
    false = sum(bool(got[i]) for i in range(200))
    found = 0
    for i, (text, value) in enumerate(planted):
        spans = [text[s.start : s.end] for s in got[200 + i] if s.kind == "tagged"]
        found += any(value in s or s in value for s in spans)
    assert false <= 2 and found >= 55, (false, found)


def test_edges(llm, edges, empty):
    rows = S.secrets(edges).collect()
    assert sorted(str(r.doc_id) for r in rows) == sorted(str(i) for i, _ in TEXTS)
    assert all(r.spans == [] for r in rows)  # nothing to learn from, nothing added
    assert S.secrets(empty).collect() == []
    long = "läuft " * 50_000 + 'secret="' + "a1" * 20 + '" end'
    texts = [(1, long), (1, long), (2, "secret: 'abcdef7'"), (None, "AKIA" + "A1" * 8)]
    df = llm.createDataFrame([(i, t, "x", "k") for i, t in texts], "doc_id long, text string, spans string, key string")
    got = sorted(S.secrets(df).collect(), key=lambda r: str(r.doc_id))
    base = [[(s.kind, s.start, s.end) for s in r.spans if s.kind != "tagged"] for r in got]
    assert base[0] == base[1] == [("assign", 300_000, 300_048), ("hex", 300_008, 300_048)]
    assert base[2] == [("assign", 0, 16)] and base[3] == [("access", 0, 20)]


def test_query_lists_spans(llm):
    rows = S.op12(llm, "/root/testdata/sf0.001").collect()
    texts = {r.doc_id: r.text or "" for r in llm.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    assert len(rows) == len(texts)
    for r in rows:
        base = [f"{S.KINDS[k]}:{a}:{b}" for a, k, b in plain_base(texts[r.doc_id])]
        assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(s.startswith(k) for s in base) for k in S.KINDS[:3])
        assert [s for s in r.spans.split(",") if s and not s.startswith("tagged")] == base
