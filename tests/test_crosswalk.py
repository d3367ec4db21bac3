from terraloom.plans import reference

NAMES = ["Reef", "Sand/Mud Bank", "Mariner's Ledge", "Pinnacle; Drowned", "Bank", "Shoal", None]
ROWS = [
    (1, "Reef;Bank", "A"), (2, "  sand/MUD   bank | 'Mariner''s Ledge'", "B"), (3, "\"Pinnacle; Drowned\"\nBank", "C"), (4, None, "D"),
    (5, "Reef / mariner's ledge\tShoal", "E"), (6, "", "F"),
]


def _tables(spark, d):
    spark.createDataFrame(ROWS, "cw_id bigint, rb_type_l3_v0_3 string, rb_type_l3_v0_4 string").write.parquet(f"{d}/rb_type_l3_crosswalk.parquet")
    spelled = [*enumerate(NAMES), (10, " REEF "), (11, "Elsewhere")]
    spark.createDataFrame(spelled, "row_id bigint, rb_type_l3 string").write.parquet(f"{d}/nw_features.parquet")


def test_every_name_of_the_crosswalk_is_found(spark, tmp_path):
    _tables(spark, tmp_path)
    got = {r.row_id: r.rb_type_l3 for r in reference.crosswalk_explode(spark, str(tmp_path)).collect()}
    assert got == {0: "A", 1: "B", 2: "B", 3: "C", 4: "A", 5: "E", 6: None, 10: "A", 11: None}


def test_names_repeated_in_any_row_are_reported(spark, tmp_path):
    _tables(spark, tmp_path)
    got = {r.old: r["count"] for r in reference.crosswalk_duplicates(spark, str(tmp_path)).collect()}
    assert got == {"reef": 2, "bank": 2, "mariner's ledge": 2}
