from pyspark.sql import functions as F

from lodestone.functions import formulas

IONS = "array<struct<site:string,abbreviation:string,coefficient:string>>"


def test_tokens(spark):
    cases = [("Cs", True), ("MA", True), ("FAPbI3", True), ("Xx", False), ("cs", False), ("", False), (None, False), ("PEA-2", True), ("A", False), ("C", True), ("MA/2", False)]
    rows = spark.createDataFrame(cases, "x string, want boolean").select("x", "want", formulas.is_token(F.col("x")).alias("got")).collect()
    assert all(r.got == r.want for r in rows), rows
    assert len(set(formulas.ELEMENTS.split())) == 118


def test_reported_spellings(spark):
    cases = [
        ("CsPbI₃", ["CsPbI3"]),
        ("MA Pb(I0.7Br0.3)3", ["MAPbI0.7Br0.33", "MAPbI0.7Br0.3"]),
        ("Pb(I0.7)3", ["PbI0.73"]),
        ("Pb(I0.7Br0.3)2.5", ["PbI0.7Br0.32.5"]),
        ("(Cs0.1FA0.9)Pb(I0.8Br0.2)₃ ", ["Cs0.1FA0.9PbI0.8Br0.23", "Cs0.1FA0.9PbI0.8Br0.2"]),
        ("Fe³⁺ − x", ["Fe3+-x"]),
        ("", [""]),
        (None, []),
    ]
    rows = spark.createDataFrame(cases, "x string, want array<string>").select("x", "want", formulas.reported_spellings(F.col("x")).alias("got")).collect()
    assert all(r.got == r.want for r in rows), rows


def test_reconstructs(spark):
    cases = [
        ("CsPbI3", [("X", "I", "3"), ("A", "Cs", "1"), ("B", "Pb", "1")], True),
        ("Cs1Pb1I3", [("A", "Cs", "1"), ("B", "Pb", "1"), ("X", "I", "3")], True),
        ("Cs1PbI3", [("A", "Cs", "1"), ("B", "Pb", "1"), ("X", "I", "3")], False),
        ("FAPb(I0.7Br0.3)3", [("A", "FA", "1"), ("B", "Pb", "1"), ("X", "I", "0.7"), ("X", "Br", "0.3")], True),
        ("FAPb(I0.7Br0.3)3", [("A", "FA", "1"), ("B", "Pb", "1"), ("X", "Br", "0.3"), ("X", "I", "0.7")], False),
        ("CsPbI3", [("A", "Cs", "1"), ("B", "Pb", None), ("X", "I", "3")], False),
        ("CsPbI3", [], False),
        ("", [], True),
        ("CsPbI3", None, False),
        (None, [], False),
    ]
    rows = spark.createDataFrame(cases, f"x string, ions {IONS}, want boolean").select("x", "ions", "want", formulas.reconstructs(F.col("x"), F.col("ions")).alias("got")).collect()
    assert all(r.got == r.want for r in rows), [r for r in rows if r.got != r.want]
