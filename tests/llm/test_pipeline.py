"""Operators 9 and 10 and the pipeline."""

import math
import random
import re

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import corpus_pipeline
from cascadia.llm import importance, near_documents, near_lines, surrogates
from cascadia.llm.common import documents
from cascadia.llm.tokens import as_ids, library_tokenizer
from tests.llm.conftest import HELPERS, prose

SECRET = b"test"
SMALL = "/root/testdata/sf0.001"

# Operator 9

TEXT = (
    "Mail Ada.Byron7@Mail7.example.com or ada.byron7@mail7.example.com, call +1 (706) 555-3138 or "
    "(706) 555-3138. Host 152.143.123.131, card 4111 1111 1111 1111, account 4785380592391139, "
    "IBAN DE89370400440532013000, file 078-05-1120. Mrs. Anna Harper met Mr Paul O'Neil; HARPER said "
    "Harper would. Frau Müller, Señora García. Госпожа Петрова. Version 2.0.1 of 2023, 3.14159 and 12 people."
)


def replaced(spark, make_docs, *rows):
    out = surrogates.replace_personal_data(make_docs(*rows), SECRET, count="n")
    return {r.doc_id: r for r in out.collect()}


def test_entities():
    found = [(e.kind, TEXT[e.start : e.stop]) for e in surrogates.find_entities(TEXT)]
    assert found == [
        ("email", "Ada.Byron7@Mail7.example.com"),
        ("email", "ada.byron7@mail7.example.com"),
        ("phone", "(706) 555-3138"),
        ("phone", "(706) 555-3138"),
        ("ip", "152.143.123.131"),
        ("number", "4111 1111 1111 1111"),
        ("number", "4785380592391139"),
        ("iban", "DE89370400440532013000"),
        ("ssn", "078-05-1120"),
        ("first_f", "Anna"),
        ("surname", "Harper"),
        ("first_m", "Paul"),
        ("surname", "O'Neil"),
        ("surname", "HARPER"),
        ("surname", "Harper"),
        ("surname", "Müller"),
        ("surname", "García"),
        ("surname", "Петрова"),
    ]


@pytest.mark.parametrize(
    "text, names",
    [
        ("Dear Mr Moss,", {"Moss"}),
        ("Ask Mr John Moss today", {"John", "Moss"}),
        ("Contact Dr. Ahmed Hassan today.", {"Ahmed", "Hassan"}),
        ("Yesterday John Moss called.", {"John", "Moss"}),
        ("When Mary Ann Lee left", {"Mary", "Ann", "Lee"}),
        ("Then Frau Dr. Weber and Mr. Paul Young met. Yesterday Rain fell", {"Weber", "Paul", "Young"}),
        ("see Mr. Ahmed Hassan", {"Ahmed", "Hassan"}),
        ("The New York Times of Monday", set()),
    ],
)
def test_names_after_capitalised_words(text, names):
    assert {text[e.start : e.stop] for e in surrogates.find_entities(text)} == names


def test_replacements(spark, make_docs):
    rows = replaced(spark, make_docs, (1, TEXT), (2, "Call (706) 555-3138, ask Ms Harper."), (3, "no data here"), (4, None), (5, ""), (None, TEXT))
    out = rows[1].text
    assert rows[1].n == 18 and rows[None].text == out
    for _, _, kind, norm in surrogates.find_entities(TEXT):
        if not kind.startswith("first"):
            assert norm not in out.casefold()
    # Coreference: the same entity reads the same, whatever its form, also in other documents.
    mails = re.findall(r"\S+@\S+\.example(?=[ ,])", out)
    assert len(mails) == 2 and mails[0] == mails[1] and re.fullmatch(r"[a-z]{3}\.[a-z]{5}\d@[a-z]{4}\d\.[a-z]{7}\.example", mails[0])
    phones = re.findall(r"\(\d{3}\) \d{3}-\d{4}", out)
    assert len(set(phones)) == 1 and phones[0] in rows[2].text
    name = re.search(r"ask Ms (\w+)\.", rows[2].text).group(1)
    assert f"{name.upper()} said {name} would" in out
    # Format and check digits, gender and script.
    card = re.search(r"card (\d{4} \d{4} \d{4} \d{4}),", out).group(1)
    assert surrogates.luhn(card.replace(" ", ""))
    assert surrogates.iban_valid(re.search(r"IBAN (DE\d{20})", out).group(1))
    assert re.search(r"Mrs\. (\w+)", out).group(1) in surrogates.FIRST_NAMES["latin", "f"]
    assert re.search(r"Mr (\w+)", out).group(1) in surrogates.FIRST_NAMES["latin", "m"]
    assert re.search(r"Госпожа [А-Я][а-я]+ова\.", out)
    assert out.endswith("Version 2.0.1 of 2023, 3.14159 and 12 people.")
    assert (rows[3].text, rows[4].text, rows[5].text, rows[3].n) == ("no data here", None, "", 0)


def test_odd_rows_stay_rows(spark, make_docs, odd_rows):
    docs = make_docs(*odd_rows)
    out = surrogates.replace_personal_data(docs, SECRET)
    assert out.schema == docs.schema and out.count() == len(odd_rows)
    assert {(r.doc_id, r.text) for r in out.collect()} >= {(k, t) for k, t in odd_rows if k != 7}
    assert surrogates.replace_personal_data(make_docs(), SECRET).count() == 0


def test_collisions_are_drawn_again(spark, monkeypatch):
    """With only a few possible numbers at first, all still end up different."""
    true = surrogates.draw

    def crowded(secret, kind, norm, attempt):
        return str(int(norm) % 5).zfill(12) if attempt == 0 else true(secret, kind, norm, attempt)

    entities = [("number", str(10**11 + i)) for i in range(40)]
    drawn = lambda spark, e, secret, attempt: spark.createDataFrame(
        [(r.kind, r.norm, crowded(secret, r.kind, r.norm, attempt), attempt) for r in e.collect()], "kind string, norm string, surrogate string, attempt int"
    )
    monkeypatch.setattr(surrogates, "_drawn", drawn)
    rows = surrogates.assign_surrogates(spark.createDataFrame(entities, surrogates.ENTITY), SECRET).collect()
    assert sorted((r.kind, r.norm) for r in rows) == entities
    assert len({r.surrogate for r in rows}) == len(rows)
    assert not {r.surrogate for r in rows} & {n for _, n in entities}


def test_many_first_names_stay_apart(spark):
    entities = [(f"first_{g}", n.casefold()) for (_, g), names in surrogates.FIRST_NAMES.items() for n in names]
    rows = surrogates.assign_surrogates(spark.createDataFrame(entities, surrogates.ENTITY), SECRET).collect()
    assert len(rows) == len(entities) == len({r.surrogate for r in rows})


def test_no_name_stays_a_name(spark):
    """With all listed names met, also by the registered key, none is drawn."""
    from cascadia.llm.queries import SURROGATE_KEY

    names = {n.casefold(): g for (_, g), listed in surrogates.FIRST_NAMES.items() for n in listed}
    entities = spark.createDataFrame([*((f"first_{g}", n) for n, g in names.items()), ("surname", "beatrix")], surrogates.ENTITY)
    for secret in (SECRET, SURROGATE_KEY):
        drawn = {r.norm: r.surrogate for r in surrogates.assign_surrogates(entities, secret).collect()}
        assert set(drawn) == {*names, "beatrix"} and len(set(drawn.values())) == len(drawn)
        assert not set(drawn.values()) & set(drawn)


def test_printed_formats(spark, make_docs):
    text = "IBAN DE89 3704 0044 0532 0130 00, AT61 1904 3002 3457 3201 NEXT, card 3782 822463 10005, call 555-3138 or 7065553138. DE89370400440532013000"
    found = [(e.kind, text[e.start : e.stop]) for e in surrogates.find_entities(text)]
    assert found == [
        ("iban", "DE89 3704 0044 0532 0130 00"),
        ("iban", "AT61 1904 3002 3457 3201"),
        ("number", "3782 822463 10005"),
        ("phone", "555-3138"),
        ("phone", "7065553138"),
        ("iban", "DE89370400440532013000"),
    ]
    out = replaced(spark, make_docs, (1, text))[1].text
    m = re.fullmatch(r"IBAN (DE\d\d(?: \d{4}){4} \d\d), (AT\d\d(?: \d{4}){4}) NEXT, card (\d{4} \d{6} \d{5}), call \d{3}-\d{4} or \d{10}\. (DE\d{20})", out)
    one, two, card, again = (x.replace(" ", "") for x in m.groups())
    assert one == again and surrogates.iban_valid(one) and surrogates.iban_valid(two) and surrogates.luhn(card)
    assert not any(text[e.start : e.stop] in out for e in surrogates.find_entities(text))


def test_nothing_of_the_table_is_left(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    before = {r.doc_id: r.text for r in docs.collect()}
    found = {k: surrogates.find_entities(t) for k, t in before.items()}
    after = {r.doc_id: r for r in surrogates.replace_personal_data(docs, SECRET, count="n").collect()}
    assert any(found.values())
    for key, entities in found.items():
        assert after[key].n == len(entities)
        assert not any(before[key][e.start : e.stop] in after[key].text for e in entities)
        if not entities:
            assert after[key].text == before[key]


# Operator 10


@settings(max_examples=40, deadline=None)
@given(st.lists(st.floats(-5, 5) | st.sampled_from([0.0, 1.0]), min_size=1, max_size=40), st.data())
def test_threshold(spark, values, data):
    k = data.draw(st.integers(0, len(values) + 1))
    got = importance.top_k_threshold(spark.createDataFrame([(float(v),) for v in values], "s double"), "s", k)
    assert got == (None if k == 0 else sorted(values, reverse=True)[min(k, len(values)) - 1])


def test_counts_equal_a_plain_count(spark, make_docs, odd_rows):
    docs = make_docs(*odd_rows).selectExpr("doc_id AS key", "text").repartition(3)
    raw, target = importance._counts(docs, np.array([5, 7]))
    expected = np.zeros((2, importance.SIZE))
    for key, text in odd_rows:
        words, _, pairs, _ = importance.ngrams([text])
        for bucket in (words, pairs):
            np.add.at(expected[0], bucket, 1)
            if key in (5, 7):
                np.add.at(expected[1], bucket, 1)
    assert (raw == expected[0]).all() and (target == expected[1]).all()


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    # A fifth of the labels is never shown.
    hidden = labels.where("doc_id % 5 = 0")
    scores = importance.quality_scores(documents(spark, folder), labels.where("doc_id % 5 <> 0"))
    rows = importance.gumbel_top_k(scores).join(hidden.withColumnRenamed("doc_id", "key"), "key").toPandas()
    good = rows[(rows.quality == 1) & (rows.toxic == 0)]
    assert good.kept.mean() > 0.97
    assert rows[rows.quality == 0].kept.mean() < 0.1
    assert rows[(rows.quality == 1) & (rows.toxic == 1)].kept.mean() < 0.4
    k = scores.where("log_odds >= 0").count()
    assert importance.gumbel_top_k(scores).where("kept").count() == k


def test_toxic_documents_go(spark):
    """Hidden toxic documents, with half of the shown toxic ones known by a label without a quality."""
    folder = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    shown = labels.where("doc_id % 5 <> 0").selectExpr("doc_id", "if(toxic = 1 and doc_id % 2 = 0, null, quality) AS quality", "toxic")
    rows = importance.gumbel_top_k(importance.quality_scores(documents(spark, folder), shown))
    rows = rows.join(labels.where("doc_id % 5 = 0").withColumnRenamed("doc_id", "key"), "key").toPandas()
    kept = lambda part: float(part.kept.mean())
    figures = kept(rows[rows.toxic == 1]), kept(rows[(rows.toxic == 1) & (rows.quality == 1)]), kept(rows[(rows.quality == 1) & (rows.toxic == 0)])
    print("kept: toxic, toxic of quality 1, good:", figures)
    assert figures[0] < 0.06 and figures[1] < 0.06 and figures[2] > 0.97


def test_noise_changes_the_sample_near_the_threshold_only(spark):
    scores = spark.createDataFrame([(i, i, i / 100 - 5) for i in range(1000)], "key long, text_key long, log_odds double")
    one, two = (importance.gumbel_top_k(scores, seed=s, temperature=0.2).toPandas() for s in (1, 2))
    assert one.kept.sum() == two.kept.sum() == 500 and (one.sort_values("key").kept.to_numpy() != two.sort_values("key").kept.to_numpy()).any()
    assert one[one.kept].log_odds.min() > -2.5 and one[~one.kept].log_odds.max() < 2.5


def label_frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


@pytest.mark.parametrize("labels", [[], [(5, 1, 0)], [(5, 0, 0), (6, None, 1), (None, 1, 0), (7, 1, None), (7, 0, 1)]])
def test_odd_rows_and_labels(spark, make_docs, odd_rows, labels):
    docs = make_docs(*odd_rows)
    out = importance.resample(docs, label_frame(spark, labels))
    assert out.schema == docs.schema
    kept = out.collect()
    assert len(kept) <= len(odd_rows)
    # Repeated rows share their fate.
    assert sum(r.doc_id == 5 for r in kept) in (0, 2)
    assert importance.resample(make_docs(), label_frame(spark, labels)).count() == 0


# Pipeline


def test_pipeline(spark):
    docs = documents(spark, SMALL)
    ids = {r.doc_id for r in docs.collect()}
    names = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.stored(stage(spark, docs, SMALL), name)
        assert docs.columns == names
        kept = {r.doc_id for r in docs.collect()}
        assert kept <= ids and len(kept) == docs.count()
        ids = kept
    pieces = corpus_pipeline.run(spark, SMALL).collect()
    tokenizer = library_tokenizer(corpus_pipeline.VOCABULARY)
    by_doc = {}
    for p in sorted(pieces, key=lambda p: (p.doc_id, p.start)):
        by_doc.setdefault(p.doc_id, []).extend(as_ids(p.ids).tolist())
    assert by_doc == {r.doc_id: [*tokenizer.encode(r.text, add_special_tokens=False).ids, 1] for r in docs.collect()}


def test_pipeline_of_odd_rows(spark, make_docs, odd_rows):
    docs = make_docs(*odd_rows)
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stored(stage(spark, docs, SMALL), name)
    assert docs.agg({"length": "max"}).first()[0] in (None, *range(2049))
    empty = make_docs()
    for name, stage in corpus_pipeline.STAGES:
        empty = corpus_pipeline.stored(stage(spark, empty, SMALL), name)
    assert empty.count() == 0


def test_planted_copies_go(spark, make_docs):
    rng = random.Random(5)
    text = prose(1, 200)
    words = text.split(" ")
    words[rng.randrange(200)] = "changed"
    rows = [(1, text), (2, text), (3, " ".join(words)), (4, prose(2, 200))]
    docs = make_docs(*rows)
    kept = corpus_pipeline.near_copies(spark, docs, SMALL)
    assert sorted(r.doc_id for r in kept.collect()) == [1, 4]
    assert math.isclose(corpus_pipeline.lines(spark, docs, SMALL).count(), 2)


@pytest.mark.parametrize("stage", ["lines", "near", "resample", "surrogates"])
def test_columns_named_like_helpers_stay(spark, make_docs, stage):
    """Also those that the operators use inside keep their values."""
    texts = [f"{prose(i, 30)}\n{prose(i % 3, 12)}\nwrite to jo.doe{i % 4}@mail.org" for i in range(12)]
    docs = make_docs(*enumerate(texts), (50, None))
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(12)], "doc_id long, quality long, toxic long")
    out = {
        "lines": lambda: near_lines.drop_near_lines(docs),
        "near": lambda: near_documents.drop_near_documents(docs),
        "resample": lambda: importance.resample(docs, labels),
        "surrogates": lambda: surrogates.replace_personal_data(docs, b"key"),
    }[stage]()
    assert out.columns == docs.columns and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
    rows = out.collect()
    assert rows
    for r in rows:
        assert all(r[n] == (None if n in ("tie", "ids") else f"own {n}") for n in HELPERS)
