"""Word normalizers: suffix stemming and dictionary lemmatization.

Stemming is a chain of column expressions (no Python UDF): a word becomes a
small struct -- the part before the stemming region and the region itself --
that ``transform`` passes through one step after another. The same chain
works on a whole word array (per document, no shuffle) or on a single
column (``stem_column``, e.g. over a vocabulary).

"Among" semantics follow the Snowball algorithms: of all listed endings the
longest one present is chosen; if its condition fails, the step does nothing.
A regex anchored at the end finds exactly that ending, since the search
tries start positions left to right.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values: published Snowball Russian stemmer ------------------------
RU_VOWELS = "аеиоуыэюя"
RU_GERUND_1 = ("в", "вши", "вшись")                       # after а or я
RU_GERUND_2 = ("ив", "ивши", "ившись", "ыв", "ывши", "ывшись")
RU_REFLEXIVE = ("ся", "сь")
RU_ADJECTIVE = ("ее", "ие", "ые", "ое", "ими", "ыми", "ей", "ий", "ый", "ой", "ем", "им", "ым",
                "ом", "его", "ого", "ему", "ому", "их", "ых", "ую", "юю", "ая", "яя", "ою", "ею")
RU_PARTICIPLE_1 = ("ем", "нн", "вш", "ющ", "щ")              # after а or я
RU_PARTICIPLE_2 = ("ивш", "ывш", "ующ")
RU_VERB_1 = ("ла", "на", "ете", "йте", "ли", "й", "л", "ем", "н", "ло", "но", "ет", "ют", "ны",
             "ть", "ешь", "нно")                             # after а or я
RU_VERB_2 = ("ила", "ыла", "ена", "ейте", "уйте", "ите", "или", "ыли", "ей", "уй", "ил", "ыл",
             "им", "ым", "ен", "ило", "ыло", "ено", "ят", "ует", "уют", "ит", "ыт", "ены", "ить",
             "ыть", "ишь", "ую", "ю")
RU_NOUN = ("а", "ев", "ов", "ие", "ье", "е", "иями", "ями", "ами", "еи", "ии", "и", "ией", "ей",
           "ой", "ий", "й", "иям", "ям", "ием", "ем", "ам", "ом", "о", "у", "ах", "иях", "ях", "ы",
           "ь", "ию", "ью", "ю", "ия", "ья", "я")
RU_DERIVATIONAL = ("ост", "ость")                          # must lie in R2
RU_SUPERLATIVE = ("ейш", "ейше")
RU_GROUP1_AFTER = "ая"
# Porter (1980) step 1a, the suffix rule set used on Latin-script words.
PORTER_1A = {"sses": "ss", "ies": "i", "ss": "ss", "s": ""}
# -----------------------------------------------------------------------------

_FIELDS = ("pre", "rv", "r2", "done", "adj", "suf")


def _ending_re(endings) -> str:
    return "(" + "|".join(sorted(set(endings), key=len, reverse=True)) + ")$"


def _st(s: Column, **kw) -> Column:
    vals = {f: s[f] for f in _FIELDS}
    vals.update(kw)
    return F.struct(*[vals[f].alias(f) for f in _FIELDS])


def _cut(rv: Column, n: Column) -> Column:
    return F.left(rv, F.length(rv) - n)


def _after(rv: Column, suf: Column, chars: str) -> Column:
    """The character before the ending exists inside the region and is one of ``chars``."""
    pos = F.length(rv) - F.length(suf)
    return (pos >= 1) & F.substring(rv, pos, 1).isin(*chars)


def _find(arr: Column, endings, when: Column | None = None) -> Column:
    """Store the longest ending present (or '') in ``suf``."""
    def f(s):
        suf = F.regexp_extract(s["rv"], _ending_re(endings), 1)
        if when is not None:
            suf = F.when(when(s), suf).otherwise(F.lit(""))
        return _st(s, suf=suf)
    return F.transform(arr, f)


def _apply(arr: Column, group1=(), after: str = RU_GROUP1_AFTER, mark: str | None = None,
           extra=None) -> Column:
    """Delete ``suf`` when present and (for group-1 endings) preceded by ``after``."""
    def f(s):
        suf = s["suf"]
        ok = suf != ""
        if group1:
            ok = ok & (~suf.isin(*group1) | _after(s["rv"], suf, after))
        if extra is not None:
            ok = ok & extra(s)
        kw = {"rv": F.when(ok, _cut(s["rv"], F.length(suf))).otherwise(s["rv"])}
        if mark:
            kw[mark] = s[mark] | ok
        return _st(s, **kw)
    return F.transform(arr, f)


def _russian_start(w: Column) -> Column:
    v, nv = f"[{RU_VOWELS}]", f"[^{RU_VOWELS}]"
    pre = F.regexp_extract(w, f"^({nv}*{v})", 1)
    r2 = F.regexp_extract(w, f"^(.*?{v}{nv}.*?{v}{nv})", 1)
    r2_start = F.when(r2 == "", F.length(w)).otherwise(F.length(r2))
    return F.struct(pre.alias("pre"), F.substring(w, F.length(pre) + 1, F.length(w)).alias("rv"),
                    r2_start.alias("r2"), F.lit(False).alias("done"), F.lit(False).alias("adj"),
                    F.lit("").alias("suf"))


def russian_stem_array(words: Column) -> Column:
    """Snowball Russian stemmer over an array<string> of lower-case words.

    Regions: RV follows the first vowel; R2 follows the second
    vowel-then-consonant. Every ending removed lies in RV.
    """
    a = F.transform(words, _russian_start)
    not_done = lambda s: ~s["done"]
    # Step 1: perfective gerund, else reflexive then adjectival / verb / noun.
    a = _apply(_find(a, RU_GERUND_1 + RU_GERUND_2), group1=RU_GERUND_1, mark="done")
    a = _apply(_find(a, RU_REFLEXIVE, not_done))
    a = _apply(_find(a, RU_ADJECTIVE, not_done), mark="adj")
    a = F.transform(a, lambda s: _st(s, done=s["done"] | s["adj"]))
    a = _apply(_find(a, RU_PARTICIPLE_1 + RU_PARTICIPLE_2, lambda s: s["adj"]),
               group1=RU_PARTICIPLE_1)
    a = _apply(_find(a, RU_VERB_1 + RU_VERB_2, not_done), group1=RU_VERB_1, mark="done")
    a = _apply(_find(a, RU_NOUN, not_done))
    # Step 2: a final и.
    a = _apply(_find(a, ("и",)))
    # Step 3: derivational ending inside R2.
    a = _apply(_find(a, RU_DERIVATIONAL),
               extra=lambda s: F.length(s["pre"]) + F.length(s["rv"]) - F.length(s["suf"]) >= s["r2"])
    # Step 4: superlative (then undouble н), or undouble н, or a soft sign.
    a = _find(a, RU_SUPERLATIVE + ("н", "ь"))

    def tidy(s):
        rv, suf = s["rv"], s["suf"]
        sup = suf.isin(*RU_SUPERLATIVE)
        rv2 = F.when(sup, _cut(rv, F.length(suf))).otherwise(rv)
        undouble = (sup & rv2.endswith("нн")) | ((suf == "н") & _after(rv, suf, "н"))
        rv3 = F.when(undouble, _cut(rv2, F.lit(1))).when(suf == "ь", _cut(rv2, F.lit(1))).otherwise(rv2)
        return _st(s, rv=rv3)
    a = F.transform(a, tidy)
    return F.transform(a, lambda s: F.concat(s["pre"], s["rv"]))


def porter1a_stem_array(words: Column) -> Column:
    """Porter step 1a on an array<string>: sses->ss, ies->i, ss->ss, s->''.
    Words of one or two letters are left alone, as in the published program,
    so no word becomes the empty string."""
    a = F.transform(words, lambda w: F.struct(
        w.alias("w"), F.regexp_extract(w, _ending_re(PORTER_1A), 1).alias("suf")))

    def f(s):
        w, suf = s["w"], s["suf"]
        out = w
        for end, rep in PORTER_1A.items():
            out = F.when((suf == end) & (F.length(w) > 2), F.concat(_cut(w, F.lit(len(end))), F.lit(rep))).otherwise(out)
        return out
    return F.transform(a, f)


STEMMERS = {"russian": russian_stem_array, "porter1a": porter1a_stem_array}


def stem_array(words: Column, stemmer: str) -> Column:
    return STEMMERS[stemmer](words)


def stem_column(word: Column, stemmer: str) -> Column:
    """Stem a single string column."""
    return F.element_at(stem_array(F.array(word), stemmer), 1)


def stem_vocabulary(terms: DataFrame, stemmer: str, col: str = "term") -> DataFrame:
    """(term, stem) for a vocabulary: the cost follows the number of
    distinct words, not the corpus."""
    return terms.select(col).distinct().select(col, stem_column(F.col(col), stemmer).alias("stem"))


def lemma_dictionary(table: DataFrame, form: str = "form", lemma: str = "lemma",
                     rank: str | None = None) -> DataFrame:
    """One lemma per form: the best-ranked analysis (smallest ``rank``), else
    the smallest lemma; forms whose lemma is NULL keep no entry."""
    t = table.where(F.col(lemma).isNotNull())
    if rank:
        best = t.groupBy(form).agg(F.min_by(lemma, F.struct(rank, lemma)).alias("lemma"))
    else:
        best = t.groupBy(form).agg(F.min(lemma).alias("lemma"))
    return best.select(F.col(form).alias("form"), "lemma")


def lemmatize(tokens: DataFrame, dictionary: DataFrame, term: str = "term") -> DataFrame:
    """Replace each token by its lemma; a form the dictionary lacks stays as
    it is (never NULL). A dictionary that measures small is broadcast; a larger
    one is salted, since the commonest words hold most tokens."""
    from lexis.operators.query import hot_join
    d = dictionary.select(F.col("form").alias(term), F.col("lemma").alias("_lemma"))
    return (hot_join(tokens, d, term, "left")
                  .withColumn(term, F.coalesce(F.col("_lemma"), F.col(term))).drop("_lemma"))


def lemmatize_postings(index, dictionary: DataFrame) -> DataFrame:
    """Postings (term, doc_id, tf) with terms replaced by lemmas and merged:
    two forms of one lemma in a document add their counts.

    Works on postings, not tokens (one row per word per document), and joins
    the dictionary with the hot/cold split of ``join_term_table``.
    """
    from lexis.operators.index import join_term_table
    d = dictionary.select(F.col("form").alias("term"), F.col("lemma").alias("_lemma"))
    p = index.postings.select("term", "doc_id", "tf")
    j = join_term_table(index, p, d, "left")
    return (j.select(F.coalesce(F.col("_lemma"), F.col("term")).alias("term"), "doc_id", "tf")
             .groupBy("term", "doc_id").agg(F.sum("tf").cast("long").alias("tf")))


# --- words that a dictionary lacks ---------------------------------------------

#: Longest ending a rule may ask for, and pairs that must agree on a rule.
MAX_ENDING, MIN_SUPPORT = 6, 2


def _endings(word: str, least, max_ending: int) -> Column:
    """Lengths of a word's endings, from ``least`` on; a letter stays before each."""
    most = F.least(F.lit(max_ending), F.length(word) - 1)
    return F.when(most >= least, F.sequence(least, most)).otherwise(F.array().cast("array<int>"))


def suffix_rules(dictionary: DataFrame, min_support: int = MIN_SUPPORT,
                 max_ending: int = MAX_ENDING) -> DataFrame:
    """(ending, cut, tail, support) learned from a (form, lemma) dictionary: of
    a word with this ending the last ``cut`` letters go and ``tail`` follows.

    A pair votes for its change at each ending that covers the letters cut; an
    ending takes the change of most votes (then the one that cuts less, then the
    smaller tail), if ``min_support`` pairs agree. A lemma that is no form of
    another is a form of itself, so endings of lemmas vote for no change. Votes
    are summed before they shuffle, so a common ending is one row a task.
    """
    lemmas = (dictionary.select(F.col("lemma").alias("form"), "lemma").distinct()
                        .join(dictionary.select("form"), "form", "left_anti"))
    pairs = dictionary.select("form", "lemma").unionByName(lemmas)
    shorter = F.least(F.length("form"), F.length("lemma"))
    same = F.when(shorter > 0, F.size(F.filter(F.sequence(F.lit(1), shorter), lambda i: F.substring(
        "form", F.lit(1), i) == F.substring("lemma", F.lit(1), i)))).otherwise(0)
    split = pairs.withColumn("same", same).select(
        "form", (F.length("form") - F.col("same")).alias("cut"),
        F.expr("substring(lemma, same + 1)").alias("tail"))
    votes = (split.withColumn("n", F.explode(_endings("form", F.greatest("cut", F.lit(1)), max_ending)))
                  .groupBy(F.expr("right(form, n)").alias("ending"), "cut", "tail")
                  .agg(F.count(F.lit(1)).alias("support")))
    best = F.min(F.struct((-F.col("support")).alias("votes"), "cut", "tail"))
    return (votes.where(F.col("support") >= min_support).groupBy("ending").agg(best.alias("b"))
                 .select("ending", "b.cut", "b.tail", (-F.col("b.votes")).alias("support")))


def guess_lemmas(words: DataFrame, rules: DataFrame, max_ending: int = MAX_ENDING,
                 term: str = "term") -> DataFrame:
    """(term, lemma, ending) of distinct words: the rule of a word's longest
    ending that has one decides; without any the word stays as it is and
    ``ending`` is NULL. Cost follows the vocabulary; endings are as skewed as
    letters are, so the join is broadcast or salted."""
    from lexis.operators.query import hot_join
    w = words.select(F.col(term).alias("term")).distinct()
    tails = (w.withColumn("n", F.explode_outer(_endings("term", F.lit(1), max_ending)))
              .select("term", F.expr("right(term, n)").alias("ending")))
    found = hot_join(tails, rules.select("ending", "cut", "tail"), "ending", "left")
    longest = F.max(F.when(F.col("cut").isNotNull(),
                           F.struct(F.length("ending").alias("n"), "ending", "cut", "tail")))
    return (found.groupBy("term").agg(longest.alias("b"))
                 .select("term", F.coalesce(F.expr("concat(substring(term, 1, length(term) - b.cut), b.tail)"),
                                            F.col("term")).alias("lemma"), F.col("b.ending").alias("ending")))


def analyse_vocabulary(terms: DataFrame, dictionary: DataFrame, min_support: int = MIN_SUPPORT,
                       max_ending: int = MAX_ENDING) -> DataFrame:
    """(term, lemma, ending, known) for every word of a vocabulary: by the
    dictionary where it has the word, else by rules learned from it."""
    rules = suffix_rules(dictionary, min_support, max_ending)
    words = terms.select("term").distinct()
    entry = dictionary.select(F.col("form").alias("term"), "lemma")
    known = words.join(entry, "term").select("term", "lemma", F.lit(None).cast("string").alias("ending"),
                                             F.lit(True).alias("known"))
    rest = words.join(entry, "term", "left_anti")
    return known.unionByName(guess_lemmas(rest, rules, max_ending).withColumn("known", F.lit(False)))
