"""Repeated units against a sequential pass."""

import re

import pytest
from llm.helpers import as_set, awkward, clashing, empty

from lexis.llm import substring_dedup as S

PASSAGE = " ".join(f"alpha{i} beta gamma." if i % 7 == 6 else f"alpha{i}" for i in range(60))
ROWS = [
    (3, "Own words come first here today. " + PASSAGE + " and then more words follow it here."),
    (1, "Header line that repeats everywhere.\n" + PASSAGE + "\nUnique end of the first text."),
    (2, "HEADER line, that repeats everywhere!\nSomething else of its own kind.\nSomething else of its own kind."),
    (4, "short one.\nshort one."), (5, None), (6, ""), (7, "Nothing of this stands anywhere else."),
    (None, "Nothing of this stands anywhere else."), (7, "Nothing of this stands anywhere else."),
]


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def brute(rows, pattern=S.UNIT, min_words=S.MIN_WORDS):
    seen, out = {}, set()
    for d, t in sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0, r[1] or "")):
        for m in pattern.finditer(t or ""):
            words = re.findall(r"\w+", m.group().casefold())
            if len(words) >= min_words:
                key = " ".join(words)
                if key in seen:
                    out.add((d, m.start(), m.end(), len(words), seen[key]))
                seen.setdefault(key, d)
    return out


@pytest.mark.parametrize("pattern", [S.UNIT, S.LINE, S.PARAGRAPH])
def test_units_after_the_first_are_found_with_offsets(spark, pattern):
    got = S.repeats(frame(spark, ROWS), pattern).select("doc_id", "start", "end", "n_words", "first_doc_id")
    assert {tuple(r) for r in got.collect()} == brute(ROWS, pattern)


def test_a_passage_inside_a_line_is_found(spark):
    spans = [r for r in S.repeated_spans(frame(spark, ROWS)).collect() if r["doc_id"] == 3]
    assert sum(r["n_words"] for r in spans) >= 50 and spans[0]["first_doc_ids"] == [1]


def test_cut_texts_keep_the_rest(spark):
    got = {}
    for r in S.remove_repeats(frame(spark, ROWS)).collect():
        got.setdefault(r["doc_id"], r["text"])
    assert got[1] == ROWS[1][1] and got[4] == ROWS[3][1] and got[5] is None and got[7] == ROWS[6][1]
    assert got[2] == "\nSomething else of its own kind.\n" and got[None] == ""
    spans = sorted((s, e) for d, s, e, *_ in brute(ROWS) if d == 3)
    want, at = "", 0
    for s, e in spans:
        if at and s == at:
            pass
        want, at = want + ROWS[0][1][at:s], e
    assert got[3].replace(" ", "") == (want + ROWS[0][1][at:]).replace(" ", "")


def test_astral_characters_keep_offsets(spark):
    rows = [(1, "same words in both of them."), (2, "😀 x.\nsame words in both of them. end 😀")]
    got = {r["doc_id"]: r["text"] for r in S.remove_repeats(frame(spark, rows)).collect()}
    assert got[2] == "😀 x.\n end 😀"


def test_awkward_clashing_and_empty(spark):
    docs = clashing(spark)
    out = S.remove_repeats(docs)
    assert out.columns == docs.columns and out.count() == docs.count()
    assert as_set(S.repeats(docs), "doc_id", "first_doc_id")
    assert S.repeated_spans(empty(spark)).count() == 0 and S.remove_repeats(empty(spark)).count() == 0
    assert S.repeated_spans(awkward(spark)).where("doc_id = 1").count() == 0


def test_both_sides_of_the_broadcast_switch(spark, monkeypatch):
    import lexis.llm.common as C
    monkeypatch.setattr(C, "BROADCAST_BYTES", -1)
    got = S.repeats(frame(spark, ROWS)).select("doc_id", "start", "end", "n_words", "first_doc_id")
    assert {tuple(r) for r in got.collect()} == brute(ROWS)


def spans_of(spark, rows, **options):
    got = {}
    for r in S.repeated_spans(frame(spark, rows), **options).collect():
        got.setdefault(r["doc_id"], []).append((r["start"], r["end"], r["n_words"]))
    return got


def test_short_sentences_within_lines_stay_unless_beside_a_longer_stretch(spark):
    short, other = "It rained on the hill again.", "They all went home after that."
    long = " ".join(f"long{i}" for i in range(20)) + "."
    rows = [(1, f"One own start. {short} Then one thing. {other} {long} And an end."),
            (2, f"Two begins so. {short} Then two things. {other} Off."),       # chance repeats
            (3, f"Three begins so. {short} Ha. {long} Off."),                     # beside the long one of 1
            (4, f"Four begins so.\n{short}\nOff."),                              # a whole line
            (5, f"{short} Five ends so.")]
    got = spans_of(spark, rows)
    assert set(got) == {3, 4}
    assert sum(n for *_, n in got[3]) == 26 and [n for *_, n in got[4]] == [6]
    assert set(spans_of(spark, rows, min_stretch=1)) == {2, 3, 4, 5}


def test_a_sentence_as_long_as_a_piece_is_no_repeat_of_itself(spark):
    rows = [(d, " ".join(f"d{d}s{i}w{j}" for j in range(S.PIECE)) + ".\n" + f"d{d} more of it.")
            for d in range(20) for i in [d]]
    rows.append((50, " ".join(f"z{i}" for i in range(40)) + ". "
                 + " ".join(f"y{i}" for i in range(S.PIECE)) + ". " + " ".join(f"x{i}" for i in range(40))))
    assert spans_of(spark, rows) == {}


def test_passages_are_caught_and_clean_documents_left_alone(spark):
    """Documents of sentences from a small stock, so that short ones repeat by
    chance; every third holds a passage of 51 to 80 words that others hold."""
    import random
    rng = random.Random(7)
    vocabulary = [f"w{i}" for i in range(900)]
    stock = [" ".join(rng.choices(vocabulary, k=rng.randint(5, 8))) + "." for _ in range(400)]
    fresh = lambda: " ".join(rng.choices(vocabulary, k=rng.randint(4, 30))) + "."     # noqa: E731
    passages = [" ".join(rng.choices([f"p{i}" for i in range(5000)], k=rng.randint(51, 80))) for _ in range(10)]
    rows, held = [], {}
    for d in range(300):
        parts = [" ".join([fresh(), rng.choice(stock), fresh()]) for _ in range(4)]
        if d % 3 == 0:
            held[d] = passages[d // 3 % 10]
            parts[2] = f"{fresh()} {held[d]} {fresh()}"
        rows.append((d, "\n".join(parts)))
    got, first = spans_of(spark, rows), {p: min(d for d in held if held[d] == p) for p in passages}
    later = [d for d in held if first[held[d]] != d]
    assert sum(d in got for d in later) >= 0.97 * len(later)
    clean = [d for d, _ in rows if d not in later]
    assert sum(d not in got for d in clean) >= 0.9 * len(clean)


def words_left(spark, rows):
    return {r["doc_id"]: r["text"].split() for r in S.remove_repeats(frame(spark, rows)).collect()}


@pytest.mark.parametrize("seed", range(4))
def test_an_unpunctuated_passage_in_mid_line_is_removed_but_for_its_ends(spark, seed):
    passage = [f"p{seed}x{i}" for i in range(60)]
    before, after = [f"b{i}" for i in range(9 + seed)], [f"a{i}" for i in range(40)]
    rows = [(1, " ".join(["one"] * 3 + passage + ["tail", "of", "one"])),
            (2, " ".join(before + passage + after)), (3, " ".join(passage).upper() + " - end")]
    got = words_left(spark, rows)
    assert got[1] == rows[0][1].split()
    for d, outside in ((2, before + after), (3, ["-", "end"])):
        kept = [w.lower() for w in got[d] if w.lower() in passage]
        assert [w for w in got[d] if w.lower() not in passage] == outside
        assert len(kept) <= 2 * (S.WINDOW - 1)
    spans = {r["doc_id"]: r for r in S.repeated_spans(frame(spark, rows)).collect()}
    assert spans[2]["n_words"] == 60 - sum(w in passage for w in got[2]) and spans[2]["first_doc_ids"] == [1]


def test_every_run_of_31_words_has_a_removed_piece_and_shorter_ones_stay(spark):
    least = S.PIECE + S.WINDOW - 1
    rows = [(0, " ".join(f"w{i}" for i in range(400)))]
    rows += [(d, " ".join([f"x{d}", *[f"w{i}" for i in range(7 * d, 7 * d + n)], f"y{d}"]))
             for d, n in [(d, least if d <= 30 else S.PIECE - 1) for d in range(1, 50)]]
    got = {r["doc_id"] for r in S.repeated_spans(frame(spark, rows)).collect()}
    assert got == set(range(1, 31))


def test_text_that_repeats_itself_keeps_its_first_words(spark):
    for period in (1, 3, 20):
        text = " ".join(f"z{i % period}" for i in range(300))
        left = words_left(spark, [(1, text)])[1]
        assert left[:S.PIECE] == text.split()[:S.PIECE] and len(left) < 70


def test_words_are_hashed_as_folded():
    text = "Straße STRASSE strasse İstanbul i\u0307stanbul 😀 ΑΣ ας x_1 X_1 e\u0301a \ud800"
    starts, ends, h = S._words(text)
    words = [text[a:b] for a, b in zip(starts, ends)]
    assert words == re.findall(r"\w+", text)
    same = {(a.casefold() == b.casefold()) == (x == y) for a, x in zip(words, h) for b, y in zip(words, h)}
    assert same == {True} and not len(S._words("")[2]) and not len(S._words(" .")[0])
