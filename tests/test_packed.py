import pytest

from terraloom.operators.packed import PackedGrammar, split_packed, vocabulary

NAMES = ["reef flat, rubble", "sand/mud bank", "pinnacle; drowned", 'shelf "step" reef', "mariner's ledge", "coral reef"]
G = PackedGrammar(NAMES)


def vals(text):
    return [v[1] for v in G.parse(text)]


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("", []),
        ("  ", []),
        (";; ,|", []),
        ("Coral Reef", ["Coral Reef"]),
        ("A;B , C|D\nE\tF", ["A", "B", "C", "D", "E", "F"]),
        ("A / B/C / D", ["A", "B/C", "D"]),
        ('"Atoll, Outer";Land', ["Atoll, Outer", "Land"]),
        ("'Atoll, Outer' , Land", ["Atoll, Outer", "Land"]),
        ('"Shelf ""Step"" Reef"; X', ['Shelf "Step" Reef', "X"]),
        ('Shelf "Step" Reef; X', ['Shelf "Step" Reef', "X"]),
        ("Reef Flat, Rubble, Sand/Mud Bank", ["Reef Flat, Rubble", "Sand/Mud Bank"]),
        ("REEF  flat, RUBBLE;x", ["REEF  flat, RUBBLE", "x"]),
        ("'Mariner's Ledge';b", ["Mariner's Ledge", "b"]),
        ("Mariner's Ledge;b", ["Mariner's Ledge", "b"]),
        ('"open, x;y', ['"open', "x", "y"]),
        ('""; " " ;a', ["a"]),
        (" 　a　;　b ", ["a", "b"]),
        ("[a, b]; c", ["[a, b]", "c"]),
        ("Bank (unsorted);x", ["Bank (unsorted)", "x"]),
        ("a；b", ["a", "b"]),
    ],
)
def test_values(text, want):
    assert vals(text) == want


def test_positions_and_flags():
    assert G.parse("a;;b") == [(1, "a", "bare", None), (2, "b", "bare", None)]
    assert G.parse('"open, x')[0][3] == "open_quote"
    assert G.parse("'Mariner's Ledge'")[0][3] == "loose_quote"


def test_long_text_is_linear():
    assert len(vals("'" + "a" * 200_000)) == 1
    assert len(vals("x;" * 50_000)) == 50_000


def test_operator(spark):
    df = spark.createDataFrame([(1, "a;b", "z"), (1, "a;b", "z"), (2, None, "z"), (None, "c", "z"), (None, "c", "z")], "k bigint, f string, val string")
    got = sorted((r.row_key or 0, r.pos, r.val) for r in split_packed(df, "k", "f", NAMES).collect())
    assert got == [(0, 1, "c"), (1, 1, "a"), (1, 2, "b")]
    assert split_packed(df.limit(0), "k", "f", []).count() == 0
    names = spark.createDataFrame([("A,  b ",), ("a, B",), (None,), ("plain",)], "n string")
    assert vocabulary(names, "n") == ["a, b"]
