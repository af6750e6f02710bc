import pytest

from kinfold.functions.text import normalize_one, normalized_entities


@pytest.mark.parametrize(("kind", "value", "expected"), [
    ("name", "ABC Technologies Pvt. Ltd.", "abc technologies private limited"),
    ("name", "M/s. Rao & Sons", "rao and sons"),
    ("name", "Nandlal Kisan L.L.P.", "nandlal kisan llp"),
    ("name", "ZEPHAY LESAI [[INC]]", "zephay lesai incorporated"),
    ("name", "Société Générale Ｉｎｃ", "societe generale incorporated"),
    ("name", "रेड परफेक्ट", "रेड परफेक्ट"),
    ("name", "j.p. morgan", "jp morgan"),
    ("name", None, ""),
    ("address", "pin: 560 001", "pin 560001"),
    ("address", "bangalore 560 001", "bangalore 560 001"),
    ("address", "tyler 75701-1234", "tyler 75701"),
    ("address", "plot12, 3rd St", "plot 12 3rd street"),
    ("address", "175 BD. DU PRÉSIDENT", "175 boulevard du president"),
    ("country", "U.S.A.", "us"),
    ("country", "Atlantis", "atlantis"),
    ("country", "", None),
])
def test_normalisation(spark, kind, value, expected):
    assert normalize_one(spark, kind, value) == expected


def test_derived(spark):
    df = spark.createDataFrame([("S1-1", "ABC Technologies Pvt. Ltd.", "123456, 12 MG Road 560001 560001", "IN"), ("S2-2", None, None, None), ("S3-3", "The Company", "", " ")], "entity_id string, business_name string, business_address string, country string")
    a, b, c = normalized_entities(df).orderBy("entity_id").collect()
    assert (a["name_core"], a["name_acronym"], a["building_number"], a["primary_postal"]) == ("abc technologies", "at", "12", "123456")
    assert a["postal_code_candidates"] == ["123456", "560001"]
    assert (b["normalized_name"], b["name_tokens"], b["primary_postal"], b["normalized_country"]) == ("", [], None, None)
    assert c["core_tokens"] == [] and c["name_core"] == "the company" and c["name_signature"] == ""
