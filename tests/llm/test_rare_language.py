"""Clean documents of a language with hardly any labelled text."""

from lendlake.llm import language_id


def test_a_language_with_one_short_document_stays(spark):
    rows = [(i, f"the house and the garden of number {i} are near the old river road", "en") for i in range(300)]
    rows += [(1000 + i, f"der garten und das haus nummer {i} liegen nahe der alten strasse", "de") for i in range(300)]
    rows += [(5000, "Ο γιατρός ήρθε χθες", "el"), (5001, "mbwa zuri akimbia", "sw")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(3)
    found = {r.doc_id: r.lang_pred for r in language_id.identify(docs, language_id.learn(docs)).collect()}
    assert found == {i: g for i, _, g in rows}
    assert {r.doc_id for r in language_id.accepted(docs).collect()} == {i for i, _, _ in rows}
