import random
import re

from flowstrata.llm import surrogates
from flowstrata.llm.surrogates import (FEMALE, MALE, MALE_CYRILLIC, Cipher, _iban_check, _luhn_digit, anonymised, checked,
                                       collisions, entities, replace_entities, surrogate)
from pyspark.sql import functions as F

KEY = b"secret"
TEXT = ('Mr. John Smith met Maria Keller; Smith called +1 (784) 555-8120, mail a.b@mail.example.com from 10.2.3.4 and '
        '8.8.8.8, card 4418452524842581, token = "3f76bb46f51625a07193ae74d1cc485f188b9b5d", DE89370400440532013000, '
        '123-45-6789, г-н Иван Петров, password=49b0203a9cc466e6ee')


def shape(s):
    return re.sub("[A-ZА-Я]", "A", re.sub("[a-zа-яё]", "a", re.sub(r"\d", "0", s)))


def test_order_is_a_cycle_without_fixed_points():
    c = Cipher(KEY)
    for n in (2, 3, 10, 97, 1000):
        got = [c.successor(i, n, "t") for i in range(n)]
        assert sorted(got) == list(range(n)) and all(a != i for i, a in enumerate(got))
    assert c.successor(0, 1, "t") == 0
    assert Cipher(b"other").successor(5, 10**9, "t") != c.successor(5, 10**9, "t")


def test_formats_gender_script_and_coreference():
    new, pairs = replace_entities(TEXT, Cipher(KEY))
    by = {(k, v): s for k, v, s in pairs}
    for (kind, value), s in by.items():
        assert s != value and value not in new, (kind, value, s)
        if kind not in ("ip", "secret", "first"):
            assert shape(s) == shape(value) and len(s) == len(value)
    assert by["first", "John"] in MALE and by["first", "Maria"] in FEMALE and by["first", "Иван"] in MALE_CYRILLIC
    assert re.fullmatch("[А-Яа-яё]+в", by["person", "Петров"])
    smith = by["person", "Smith"]
    assert new.count(smith) == 2 and f"Mr. {by['first', 'John']} {smith} met" in new
    card = by["card", "4418452524842581"]
    assert int(card[-1]) == _luhn_digit(card[:-1]) and card[:4] == "4418"
    iban = by["iban", "DE89370400440532013000"]
    assert int(iban[2:4]) == _iban_check("DE", iban[4:])
    assert by["ip", "10.2.3.4"].startswith("10.") and not by["ip", "8.8.8.8"].startswith("10.")
    assert set(by["secret", "3f76bb46f51625a07193ae74d1cc485f188b9b5d"]) <= set("0123456789abcdef")
    assert by["phone", "+1 (784) 555-8120"].startswith("+1 (")
    assert replace_entities(TEXT, Cipher(KEY))[0] == new and replace_entities(TEXT, Cipher(b"x"))[0] != new


def test_surrogates_are_distinct_over_a_whole_format():
    c = Cipher(KEY)
    for kind, values in (("ssn", [f"00{i // 100}-{i % 100:02d}-0000" for i in range(300)]),
                         ("secret", [f"{i:06x}" for i in range(500)] + [f"pass{i}" for i in range(300)]),
                         ("ip", [f"9.8.{i // 256}.{i % 256}" for i in range(700)] + [f"172.{i}.0.1" for i in range(256)]),
                         ("email", [f"a{i}@b{j}.org" for i in range(20) for j in range(9)]),
                         ("card", [f"4111111111{i:05d}0" for i in range(400)]),
                         ("person", ["Smith", "Smyth", "Keller", "Kellor", "Li", "Lu", "Ли"]),
                         ("first", [*MALE, *FEMALE, "Zoe", "Zoa"])):
        got = [surrogate(v, kind, c) for v in values]
        assert len(set(got)) == len(set(values)), kind
        assert all(a != b for a, b in zip(got, values)), kind


def test_clean_text_is_left_alone():
    text = "In 1999 the 12 men of Section 4.2 sold 3,000 units at 10:30, see v1.2.3 and a=b."
    assert replace_entities(text, Cipher(KEY)) == (text, [])
    assert entities("") == [] and replace_entities(None, Cipher(KEY)) == (None, [])


def test_all_mentions_of_a_person():
    new, pairs = replace_entities("Anna Schmidt came. Anna left. SCHMIDT. Schmidt's and Schmidt-based; ANNA", Cipher(KEY))
    by = {(k, v): s for k, v, s in pairs}
    first, last = by["first", "Anna"], by["person", "Schmidt"]
    assert new == f"{first} {last} came. {first} left. {last.upper()}. {last}'s and {last}-based; {first.upper()}"
    assert replace_entities("Mr SCHMIDT", Cipher(KEY))[0] == f"Mr {last.upper()}"  # the same person in another text
    for text in ("Anna Schmidt and Wei Zhang, Priya Raghavan", "my name is Priya Raghavan, and Wei Zhang"):
        new, pairs = replace_entities(text, Cipher(KEY))
        assert not any(w in new for w in ("Wei", "Zhang", "Priya", "Raghavan")), new
    text = "The New York and Los Angeles offices named the product, Blue Water."
    assert replace_entities(text, Cipher(KEY)) == (text, [])


def test_short_and_accented_names_stay_distinct():
    names = ["Øi", "Åm", "Ås", "Äs", "Łu", "Šo", "Ъя", "Ðo", "Þo", "Œu", "Paul", "Anna", "Li"]
    got = [replace_entities(f"Mr {n}", Cipher(KEY))[0][3:] for n in names]
    assert len(set(got)) == len(names) and all(a != b for a, b in zip(got, names))
    assert all("X" not in g for g in got) and [shape_of(g) for g in got] == [shape_of(n) for n in names]
    # every two-letter name of a form, known names of the lists too
    many = [a + b for a in "ÀÉÍÓØÅ" for b in "aeou"] + [*MALE, *FEMALE]
    assert len({surrogate(n, "person", Cipher(KEY)) for n in many}) == len(many)


def shape_of(s):
    return [c.isupper() for c in s] if len(s) == 2 else s[0].isupper()


def test_spaced_ibans_and_bare_numbers():
    new, pairs = replace_entities("IBAN DE89 3704 0044 0532 0130 00, call me at 5551234567 by 1700000000", Cipher(KEY))
    assert [k for k, _, _ in pairs] == ["iban", "phone"] and new.endswith("by 1700000000")
    plain = pairs[0][2].replace(" ", "")
    assert shape(pairs[0][2]) == shape(pairs[0][1]) and int(plain[2:4]) == _iban_check("DE", plain[4:])
    joined = replace_entities("DE89370400440532013000", Cipher(KEY))[1][0][2]
    assert joined == plain  # one account, one surrogate


def test_long_texts_take_linear_time():
    text = " ".join(f"Mr {a}{b}{c}son met" for a in "BCDFGHKLMN" for b in "aeiou" for c in "bcdfglmnpr") * 40
    new, pairs = replace_entities(text, Cipher(KEY))
    assert len(pairs) == 20_000 and len({s for _, _, s in pairs}) == 500


def test_nothing_known_survives_in_random_places():
    rng = random.Random(1)
    values = ["a.b@mail.example.com", "4418452524842581", "+1 (784) 555-8120", "52.139.117.253", "password=49b0203a9cc466e6ee"]
    for _ in range(100):
        rng.shuffle(values)
        text = " ".join(w for v in values for w in (v + rng.choice(["", ".", ",", "\n"]), "word"))
        new, pairs = replace_entities(text, Cipher(KEY))
        assert len(pairs) == 5 and not any(v.split("=")[-1] in new for v in values)


def test_odd_rows(spark, odd_docs, make_docs):
    docs = odd_docs.unionByName(make_docs([(70, TEXT, "en", "z"), (70, TEXT, "en", "z"), (71, (TEXT + "\n") * 200, "en", "z")]))
    out = anonymised(docs, KEY)
    rows = {r["doc_id"]: r for r in out.collect()}
    assert out.columns == [*docs.columns, "n_entities", "entity_kinds"] and out.count() == docs.count()
    assert rows[2]["text"] is None and rows[2]["n_entities"] == 0 and rows[3]["text"] == ""
    assert rows[70]["entity_kinds"] == "card,email,iban,ip,person,phone,secret,ssn"
    assert rows[71]["text"] == (rows[70]["text"] + "\n") * 200
    assert collisions(docs, KEY).count() == 0
    both = checked(docs.withColumn("collisions", F.lit("x")), KEY)
    assert both.columns == [*docs.columns, "n_entities", "entity_kinds", "collisions"]
    assert {r["collisions"] for r in both.collect()} == {0} and both.count() == docs.count()
    assert checked(docs.where("false"), KEY).count() == 0


def test_collisions_are_counted(spark, make_docs, monkeypatch):
    docs = make_docs([(1, "Mr Keller", "en", "z"), (2, "Mr Koller", "en", "z"), (2, "Mr Smith", "en", "z")])
    monkeypatch.setattr(surrogates, "surrogate", lambda value, kind, cipher: value[0] + str(len(value)))
    assert [tuple(r) for r in collisions(docs, KEY).collect()] == [("person", "K6", 2)]
    assert {r["collisions"] for r in checked(docs, KEY).collect()} == {1}
    assert anonymised(docs.where("false"), KEY).count() == 0
