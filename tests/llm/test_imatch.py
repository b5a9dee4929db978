from __future__ import annotations

import hashlib
import random

from wearspan.llm import imatch


def test_edited_texts_and_neighbours(documents):
    rng = random.Random(8)
    words = [f"w{rng.randrange(10**6)}" for _ in range(3000)]
    rows = [(3 * i, " ".join(rng.choices(words, k=rng.randrange(20, 400)))) for i in range(60)]
    rows += [(1, "é\U0001f600x"), (2, ""), (4, None), (500, rows[7][1])]
    out = {r["doc_id"]: r for r in imatch.fingerprints(documents(rows, code=1, text_=2)).collect()}
    texts = [(i, t or "") for i, t in sorted(rows)]
    for k, (i, t) in enumerate(texts):
        n = len(t) // 4
        edited = t[: len(t) - n] + texts[(k + 1) % len(texts)][1][:n]
        assert out[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest(), i
        assert out[i]["n_chars"] == len(t)
        assert 0 <= out[i]["near_next"] <= 1 and 0 <= out[i]["near_edited"] <= 1
    assert out[21]["fingerprint"] == out[500]["fingerprint"]
    long = [out[i] for i, _ in rows[:60]]
    assert sum(r["near_edited"] > r["near_next"] for r in long) > 55


def test_repeated_rows_and_small_tables(documents):
    assert imatch.fingerprints(documents([])).count() == 0
    alone = imatch.fingerprints(documents([(9, "abcdefgh")])).first()
    assert alone["edited_sha256"] == hashlib.sha256(b"abcdefab").hexdigest()
    rows = [(1, "one two three four"), (1, "one two three four"), (1, "other text"), (None, "no name"), (2, "last")]
    out = imatch.fingerprints(documents(rows)).collect()
    assert sorted(str(r["doc_id"]) for r in out) == ["1", "1", "1", "2", "None"]


def test_very_frequent_words_do_not_thin_the_lexicon(documents):
    frequent = [f"often{i}" for i in range(760)]
    rows = [(i, " ".join([*(f"own{i}x{k}" for k in range(40)), *frequent])) for i in range(12)]
    # An even one is followed by its exact copy, whose beginning then replaces its end.
    rows = [(2 * i + j, t) for i, t in rows for j in (0, 1)]
    for r in imatch.fingerprints(documents(rows)).collect():
        level, _, hashes = r["fingerprint"].split(";")[0].partition(":")
        assert level == "0" and sum(h != "" for h in hashes.split(",")) >= 10
        assert [r["near_edited"] == 1.0, r["near_next"] == 1.0] == [r["doc_id"] % 2 == 0] * 2


def test_words_cut_by_the_edit_are_no_terms(documents):
    # The word at the seam of an edited text and its last one are cut, and in no document.
    out = {r["doc_id"]: r for r in imatch.fingerprints(documents([(1, "alpha beta gamma1234"), (2, "alpha delta epsilon12"), (3, "zeta eta"), (4, "theta iota")])).collect()}
    filled = {i: sum(h != "" for h in out[i]["edited_fingerprint"].split(";")[0].partition(":")[2].split(",")) for i in (1, 2)}
    assert filled[1] <= 2 and filled[2] <= 2
