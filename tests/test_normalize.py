"""Stemmers and dictionary lemmatization."""

from pyspark.sql import functions as F

from lexis.operators.index import build_index
from lexis.operators.normalize import lemma_dictionary, lemmatize_postings, stem_column
from lexis.profile import LATIN

# Word -> stem pairs worked by hand through the published algorithm, one or
# more per rule: gerund (group 1 after a/ya), reflexive, adjective with and
# without participle, verb, noun, final i, derivational in R2 and not in R2,
# superlative, double n, soft sign, no vowel.
RU_PAIRS = [
    ("бегавшись", "бега"), ("падающего", "пада"), ("важнейшими", "важн"),
    ("павловной", "павловн"), ("хранила", "хран"), ("пароли", "парол"),
    ("безопасность", "безопасн"), ("важность", "важност"), ("красивейшие", "красив"),
    ("длинный", "длин"), ("доступе", "доступ"), ("миллионов", "миллион"),
    ("кое-что", "кое-чт"), ("-", "-"), ("мгм", "мгм"),
]


def test_russian_snowball(spark):
    df = spark.createDataFrame(RU_PAIRS, "w string, want string")
    got = df.select("want", stem_column(F.col("w"), "russian").alias("got")).collect()
    assert [r.got for r in got] == [r.want for r in got]


def test_porter_1a(spark):
    pairs = [("caresses", "caress"), ("ponies", "poni"), ("caress", "caress"), ("cats", "cat"),
             ("s", "s"), ("is", "is"), ("ies", "i"), ("bus", "bu"), ("tree", "tree")]
    df = spark.createDataFrame(pairs, "w string, want string")
    got = df.select("want", stem_column(F.col("w"), "porter1a").alias("got")).collect()
    assert [r.got for r in got] == [r.want for r in got]


def test_lemma_dictionary_first_analysis_and_nulls(spark):
    t = spark.createDataFrame([("went", "go", 1), ("went", "wend", 2), ("saw", None, 1),
                               ("rose", "rise", 2), ("rose", "rose", 1)],
                              "form string, lemma string, rank int")
    d = {r.form: r.lemma for r in lemma_dictionary(t, rank="rank").collect()}
    assert d == {"went": "go", "rose": "rose"}       # NULL analysis -> no entry


def test_lemmatize_postings_merges_counts(spark):
    docs = spark.createDataFrame([(1, "went go goes went"), (2, "saw")], "doc_id long, text string")
    idx = build_index(docs, LATIN)
    d = spark.createDataFrame([("went", "go"), ("goes", "go")], "form string, lemma string")
    got = sorted((r.term, r.doc_id, r.tf) for r in lemmatize_postings(idx, d).collect())
    assert got == [("go", 1, 4), ("saw", 2, 1)]


# --- the Russian stemmer over a whole vocabulary -----------------------------
# A second implementation, on plain strings, written from the published
# description of the algorithm: RV, R2, four steps; the longest ending counts.

VOWELS = "аеиоуыэюя"


def endings(text):
    return sorted(text.split(), key=len, reverse=True)


GERUND1, GERUND2 = endings("в вши вшись"), endings("ив ивши ившись ыв ывши ывшись")
ADJECTIVE = endings("ее ие ые ое ими ыми ей ий ый ой ем им ым ом его ого ему ому их ых ую юю ая яя ою ею")
PARTICIPLE1, PARTICIPLE2 = endings("ем нн вш ющ щ"), endings("ивш ывш ующ")
VERB1 = endings("ла на ете йте ли й л ем н ло но ет ют ны ть ешь нно")
VERB2 = endings("ила ыла ена ейте уйте ите или ыли ей уй ил ыл им ым ен ило ыло ено ят ует уют ит ыт ены "
                "ить ыть ишь ую ю")
NOUN = endings("а ев ов ие ье е иями ями ами еи ии и ией ей ой ий й иям ям ием ем ам ом о у ах иях ях ы ь ию "
               "ью ю ия ья я")


def cut(rv, free, after=()):
    """rv without its longest ending, or None; endings of ``after`` must
    follow а or я, which stays."""
    for e in sorted([*free, *after], key=len, reverse=True):
        if rv.endswith(e):
            if e in free and e not in after:
                return rv[:len(rv) - len(e)]
            return rv[:len(rv) - len(e)] if rv[:len(rv) - len(e)][-1:] in ("а", "я") else None
    return None


def second_stem(word):
    first = next((i for i, c in enumerate(word) if c in VOWELS), None)
    if first is None:
        return word
    pre, rv = word[:first + 1], word[first + 1:]

    def region(text, start):
        for i in range(start, len(text) - 1):
            if text[i] in VOWELS and text[i + 1] not in VOWELS:
                return i + 2
        return len(text)

    r2 = region(word, region(word, 0))
    done = cut(rv, GERUND2, GERUND1)
    if done is not None:
        rv = done
    else:
        rv = next((rv[:-2] for e in ("ся", "сь") if rv.endswith(e)), rv)
        adj = cut(rv, ADJECTIVE)
        if adj is not None:
            part = cut(adj, PARTICIPLE2, PARTICIPLE1)
            rv = adj if part is None else part
        else:
            verb = cut(rv, VERB2, VERB1)
            noun = cut(rv, NOUN)
            rv = verb if verb is not None else noun if noun is not None else rv
    rv = rv[:-1] if rv.endswith("и") else rv
    for e in ("ость", "ост"):
        if rv.endswith(e):
            if len(pre) + len(rv) - len(e) >= r2:
                rv = rv[:-len(e)]
            break
    for e in ("ейше", "ейш"):
        if rv.endswith(e):
            rv = rv[:-len(e)]
            return pre + (rv[:-1] if rv.endswith("нн") else rv)
    if rv.endswith("нн"):
        return pre + rv[:-1]
    return pre + (rv[:-1] if rv.endswith("ь") else rv)


def test_russian_stems_of_a_corpus_vocabulary(spark):
    from conftest import SF01

    from lexis.plans.registry import QUERIES
    got = QUERIES["russian_stem_vocabulary"](spark, SF01).collect()
    assert len(got) > 1000
    wrong = [(r.term, r.stem, second_stem(r.term)) for r in got if r.stem != second_stem(r.term)]
    assert not wrong, wrong[:10]


def test_russian_second_implementation_agrees_on_the_worked_pairs():
    assert [(w, second_stem(w)) for w, _ in RU_PAIRS] == RU_PAIRS
