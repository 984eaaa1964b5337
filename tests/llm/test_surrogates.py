"""PII surrogates: form, coreference, distinctness, untouched rest."""

import re

import pytest
from conftest import SF001, SF01
from llm.helpers import awkward, clashing, empty
from pyspark.sql import functions as F

from lexis.llm import surrogates as P

TEXTS = [
    (1, "Mail Anna.B@mail1.example.com or call +1 (469) 555-8958, ip 10.20.30.40."),
    (2, "anna.b@MAIL1.example.com; 469-555-8958; +1 (469) 555-8958; card 4111 1111 1111 1111 / 4111111111111111"),
    (3, 'password=36fdea71d793cf922e token = "c1f80f127674f6764aed23d9333c5f5659a6d986" VS35VJPGNY5TFH2'),
    (4, "Frau Anna met Mr. Ivan Petrov. Dr. Müller left."), (5, None), (6, ""), (7, "nothing here 12 a@b"),
]


def replaced(spark, rows, key=P.KEY):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return {r["doc_id"]: (r["text"], r["n_entities"]) for r in P.pseudonymise(df, key).collect()}


def luhn(s):
    d = [int(c) for c in s][::-1]
    return (sum(d[::2]) + sum(x * 2 - 9 * (x > 4) for x in d[1::2])) % 10 == 0


def shape(s):
    return re.sub("[a-z]", "a", re.sub("[A-Z]", "A", re.sub("[0-9]", "0", s)))


def test_form_and_coreference(spark):
    got = replaced(spark, TEXTS)
    t1, t2, t3, t4 = (got[i][0] for i in (1, 2, 3, 4))
    mail1, mail2 = (re.search(r"\S+@\S+\.example\.com", t).group() for t in (t1, t2))
    assert mail1.lower() == mail2.lower() and "anna" not in mail1.lower()
    phones = re.findall(r"\+1 \(\d{3}\) \d{3}-\d{4}|\+\d \(\d{3}\) \d{3}-\d{4}", t1 + t2)
    assert len(phones) == 2 and phones[0] == phones[1] != "+1 (469) 555-8958"
    octets = re.search(r"ip (\d+)\.(\d+)\.(\d+)\.(\d+)\.", t1).groups()
    assert all(1 <= int(o) <= 254 for o in octets)
    spaced, solid = re.search(r"card (\d{4} \d{4} \d{4} \d{4}) / (\d{16})", t2).groups()
    assert spaced.replace(" ", "") == solid and luhn(solid) and solid != "4111111111111111"
    assert re.fullmatch(r'password=[0-9a-f]{18} token = "[0-9a-f]{40}" VS\d\d[A-Z0-9]{11}', t3)
    assert shape(t3[-15:]) == shape(TEXTS[2][1][-15:]) and t3 != TEXTS[2][1]
    name = re.search(r"Frau (\w+) met Mr\. (\w+) (\w+)\. Dr\. (\w+) left", t4).groups()
    assert [len(n) for n in name] == [4, 4, 6, 6] and name[0].endswith("a") and name[2].endswith("v")
    assert got[5] == (None, 0) and got[6] == ("", 0) and got[7] == (TEXTS[6][1], 0)


def test_key_decides(spark):
    one, again, other = (replaced(spark, TEXTS, k) for k in ("k1", "k1", "k2"))
    assert one == again and one[1] != other[1]


def test_surrogates_stay_distinct_when_draws_collide(spark, monkeypatch):
    ents = spark.createDataFrame([("phone", f"{i:02d}") for i in range(0, 40)], "kind string, norm string")
    got = P.entity_table(ents).collect()               # 40 entities, 60 free two-digit values
    monkeypatch.undo()
    subs = [r["sub"] for r in got]
    assert len(got) == 40 and len(set(subs)) == 40
    assert not set(subs) & {r["norm"] for r in got}


def test_short_entities_get_longer_surrogates_when_all_are_taken(spark):
    letters = "abcdefghijklmnopqrstuvwxyz"
    ents = [("email", f"{c}@x.com") for c in letters] + [("name", f"{c.upper()}a") for c in letters]
    got = P.entity_table(spark.createDataFrame(ents, "kind string, norm string")).collect()
    assert len({(r["kind"], r["sub"]) for r in got}) == 52
    assert not {(r["kind"], r["sub"]) for r in got} & set(ents)
    assert all(r["sub"].endswith("a") for r in got if r["kind"] == "name")


def test_fixture_keeps_everything_else(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    new = {r["doc_id"]: r for r in P.pseudonymise(docs).collect()}
    changed = 0
    for r in docs.collect():
        gaps, out = re.split(r"(\S+@\S+)", r["text"]), new[r["doc_id"]]
        assert len(out["text"]) == len(r["text"]) or out["n_entities"] > 0
        if out["n_entities"] == 0:
            assert out["text"] == r["text"]
        else:
            changed += 1
            assert out["text"] != r["text"]
            for mail in re.findall(r"[\w.]+@mail\d\.example\.com", r["text"]):
                assert mail not in out["text"]
        assert gaps
    assert changed > 0


def test_native_awkward_clashing_empty(spark):
    out = P.pseudonymise(clashing(spark))
    assert out.columns == clashing(spark).columns + ["n_entities"] and out.count() == clashing(spark).count()
    assert P.pseudonymise(empty(spark)).count() == 0
    assert {r["text"] for r in P.pseudonymise(awkward(spark)).collect()} == {
        r["text"] for r in awkward(spark).collect()}
    assert not re.search("Python|Arrow", out._jdf.queryExecution().toString())


def test_secret_keywords_in_any_case(spark):
    got = replaced(spark, [(1, 'TOKEN = "9233A8EC11D793CF922E" Password: 36fdea71d793cf922e')])
    assert got[1][1] == 2 and re.fullmatch(r'TOKEN = "[0-9A-Z]{20}" Password: [0-9a-f]{18}', got[1][0])
    assert "9233A8EC11D793CF922E" not in got[1][0] and "36fdea71d793cf922e" not in got[1][0]


def test_a_phone_ends_where_another_number_starts(spark):
    got = replaced(spark, [(1, "+1 (826) 555-4081 190.137.223.204 end"), (2, "+1 (826) 555-4081."),
                           (3, "+1 (826) 555-4081 4111 1111 1111 1111"), (4, "+49 30 1234 5678 190.137.223.204 x")])
    phones = [re.match(r"\+\d \(\d{3}\) \d{3}-\d{4}", got[i][0]).group() for i in (1, 2, 3)]
    assert len(set(phones)) == 1 and [got[i][1] for i in (1, 2, 3, 4)] == [2, 1, 2, 2]
    ips = [re.search(r" (\d+\.\d+\.\d+\.\d+) ", got[i][0]).group(1) for i in (1, 4)]
    assert ips[0] == ips[1] != "190.137.223.204" and luhn(re.sub(r"\D", "", got[3][0][18:]))


def test_names_are_found_again_without_their_title(spark):
    got = replaced(spark, [(1, "Dr. Anna Petrov came. Petrov said; Anna Petrov, Petrovs and Petrov's friend Anna."),
                           (2, "Mr Petrov met Petrov"), (3, "Petrov has no title here.")])
    first, last, again, both, friend = re.fullmatch(
        r"Dr\. (\w+) (\w+) came\. (\w+) said; (\w+ \w+), Petrovs and (\w+)'s friend \1\.", got[1][0]).groups()
    assert last == again == friend != "Petrov" and both == f"{first} {last}" and first != "Anna"
    assert got[1][1] == 5 and got[2] == (f"Mr {last} met {last}", 2) and got[3] == ("Petrov has no title here.", 0)


def test_no_entity_of_any_type_is_left_in_the_fixture(spark):
    plain = {"secret": r"(?i)token\s*=\s*\"?([0-9a-f]{12,})", "ip": r"(?<![\d.])(\d+\.\d+\.\d+\.\d+)(?!\d)",
             "phone": r"(\+1 \(\d{3}\) \d{3}-\d{4})", "email": r"([\w.]+@[\w.]+\w)",
             "name": r"(?:Mr|Mrs|Ms|Dr|Herr|Frau|Mme|Sr|Sra)\.? ([A-Z][a-z]+)"}
    docs = spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "text")
    extra = spark.createDataFrame([(-1, 'TOKEN = "9233A8EC11D793CF922E" +1 (826) 555-4081 190.137.223.204 '
                                        'Dr. Anna Petrov and Petrov')], docs.schema)
    docs = docs.unionByName(extra)
    new, seen = {r["doc_id"]: r["text"] for r in P.pseudonymise(docs).collect()}, set()
    for r in docs.collect():
        for kind, pattern in plain.items():
            for value in re.findall(pattern, r["text"]):
                seen.add(kind)
                assert value not in new[r["doc_id"]], (r["doc_id"], kind)
    assert seen == set(plain)
