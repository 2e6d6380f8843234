"""The driver keeps no copy of the language model, nor its words one by one, once tasks are done with them."""

import os

from skylag.llm import language_model


def test_copies_of_rounds_are_gone_and_words_are_one_text(llm, monkeypatch):
    sent = []
    send = llm.sparkContext.broadcast
    monkeypatch.setattr(llm.sparkContext, "broadcast", lambda value: sent.append((value, send(value))) or sent[-1][1])
    monkeypatch.setattr(language_model, "LEAST_DRAWS", 1)
    docs = llm.createDataFrame([(i, f"one two three{i % 7}\u3000x four") for i in range(60)], "doc_id long, text string")
    scores = language_model.language_scores(docs)
    (words, _), *copies = sent
    assert isinstance(words, bytes) and len(words.split()) == 10
    assert [os.path.exists(b._path) for _, b in copies] == [False, False, True]
    assert scores.count() == 60 and all(r.n_known == 5 for r in scores.collect())
