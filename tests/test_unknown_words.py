"""Lemmas of words that a dictionary lacks, against a loop over plain strings."""

import random
from collections import Counter, defaultdict

from lexis.operators import query
from lexis.operators.normalize import (analyse_vocabulary, guess_lemmas, lemma_dictionary,
                                       suffix_rules)

PAIRS = [("cats", "cat"), ("dogs", "dog"), ("ponies", "pony"), ("cities", "city"), ("parties", "party"),
         ("boxes", "box"), ("foxes", "fox"), ("went", "go"), ("running", "run"), ("a", "a"), ("\u0301s", "\u0301"),
         ("кошками", "кошка"), ("собаками", "собака"), ("рыбами", "рыба")]


def frame(spark, pairs):
    return spark.createDataFrame(pairs, "form string, lemma string")


def brute_rules(pairs, support=2, longest=6):
    forms = {f for f, _ in pairs}
    votes = defaultdict(Counter)
    for form, lemma in pairs + sorted({(l, l) for _, l in pairs if l not in forms}):
        same = 0
        while same < min(len(form), len(lemma)) and form[same] == lemma[same]:
            same += 1
        for n in range(max(len(form) - same, 1), min(longest, len(form) - 1) + 1):
            votes[form[-n:]][(len(form) - same, lemma[same:])] += 1
    out = {}
    for ending, of in votes.items():
        n, cut, tail = min((-n, *rule) for rule, n in of.items())
        if -n >= support:
            out[ending] = (cut, tail, -n)
    return out


def brute_guess(word, rules, longest=6):
    for n in range(min(longest, len(word) - 1), 0, -1):
        if word[-n:] in rules:
            cut, tail, _ = rules[word[-n:]]
            return word[:len(word) - cut] + tail, word[-n:]
    return word, None


def rules_of(df):
    return {r.ending: (r.cut, r.tail, r.support) for r in df.collect()}


def test_rules_are_those_of_the_loop(spark):
    for support in (1, 2, 3):
        assert rules_of(suffix_rules(frame(spark, PAIRS), support)) == brute_rules(PAIRS, support)


def test_longest_ending_decides_on_both_sides_of_the_broadcast(spark, monkeypatch):
    words = ["babies", "hens", "taxes", "кошками", "лисами", "x", "s", "", "zzz", "hens", "go"]
    df = spark.createDataFrame([(w,) for w in words], "term string")
    rules = brute_rules(PAIRS)
    want = {w: brute_guess(w, rules) for w in words}
    assert want["babies"] == ("baby", "ies") and want["лисами"][0] == "лиса" and want["x"] == ("x", None)
    for bound in (query.QUERY_BROADCAST_MAX_BYTES, -1):
        monkeypatch.setattr(query, "QUERY_BROADCAST_MAX_BYTES", bound)
        got = guess_lemmas(df, suffix_rules(frame(spark, PAIRS)))
        assert sorted((r.term, (r.lemma, r.ending)) for r in got.collect()) == sorted(want.items())


def test_dictionary_entries_come_first_and_empty_inputs(spark):
    terms = spark.createDataFrame([("went",), ("wolves",), ("cats",)], "term string")
    got = {r.term: (r.lemma, r.known) for r in analyse_vocabulary(terms, frame(spark, PAIRS)).collect()}
    assert got["went"] == ("go", True) and got["cats"] == ("cat", True) and not got["wolves"][1]
    none = analyse_vocabulary(terms, frame(spark, [])).collect()
    assert sorted((r.term, r.lemma, r.ending) for r in none) == [
        ("cats", "cats", None), ("went", "went", None), ("wolves", "wolves", None)]
    assert analyse_vocabulary(terms.limit(0), frame(spark, PAIRS)).count() == 0


def test_held_out_forms_are_analysed(spark):
    """Regular forms of made-up stems; rules from four fifths, the rest judged."""
    rng = random.Random(3)
    stems = {"".join(rng.choices("bdfgklmnprt", k=2) + rng.choices("aeiou", k=1) + rng.choices("bdgklmnprt", k=2))
             for _ in range(600)}
    pairs = [(stem + a, stem + b) for i, stem in enumerate(sorted(stems))
             for a, b in [(("s", ""), ("ies", "y"), ("ing", "e"), ("ами", "а"))[i % 4]]]
    rng.shuffle(pairs)
    held, learned = pairs[:len(pairs) // 5], pairs[len(pairs) // 5:]
    words = spark.createDataFrame([(f,) for f, _ in held], "term string")
    guessed = {r.term: r.lemma for r in
               guess_lemmas(words, suffix_rules(lemma_dictionary(frame(spark, learned)))).collect()}
    right = sum(guessed[f] == lemma for f, lemma in held)
    assert right >= 0.95 * len(held)
