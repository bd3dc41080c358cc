"""P6-P8 column choice and items, J1 resolution tiers."""

from taxograde.operators.mapping import (choose_code_columns, choose_name_column,
                                         mapping_items, resolve_expected)


def test_column_choice():
    assert choose_name_column(["编号", "技术名称", "IPC"]) == "技术名称"
    assert choose_code_columns(["编号", "技术名称", "IPC"], "技术名称") == ["IPC"]
    assert choose_name_column(["Technology Code"]) == "Technology Code"
    # the same column can be name and code
    assert choose_code_columns(["Technology Code"], "Technology Code") == ["Technology Code"]
    assert choose_name_column(["foo", "bar"]) == "foo"
    assert choose_code_columns(["foo", "bar"], "foo") == ["bar"]


def test_items_and_tiers(spark):
    raw = spark.createDataFrame([
        ("D", 0, "Radar", "g01s 13/89, G01S"),
        ("D", 1, " nan ", "X01"),
        ("D", 2, "Lidar_Technology", "G01S17"),
        ("D", 3, "Vision", ""),
        ("D", 4, "Radar", "H99"),
        ("E", 0, "Other", "B60"),
    ], "domain string, ord long, name string, codes string")
    items = mapping_items(raw, name_col="name", code_cols=["codes"])
    got = {(r["domain"], r["ord"]): (r["tech_name"], r["codes"]) for r in items.collect()}
    assert got == {("D", 0): ("Radar", ["13", "89", "G01S"]),
                   ("D", 2): ("Lidar_Technology", ["G01S17"]),
                   ("D", 4): ("Radar", ["H99"]),
                   ("E", 0): ("Other", ["B60"])}
    tech = spark.createDataFrame([("D", " Radar "), ("D", "Lidar"), ("D", "Sonar"),
                                  ("D", "Radar_Technology_X"), ("F", "Radar")],
                                 "domain string, tech_name_raw string")
    res = {(r["domain"], r["tech_name_raw"]): (r["resolution_tier"], r["expected_codes"])
           for r in resolve_expected(tech, items).collect()}
    assert res[("D", " Radar ")] == (0, ["13", "89", "G01S"])          # trimmed equality
    assert res[("D", "Lidar")] == (1, ["G01S17"])                     # tech inside item name
    assert res[("D", "Radar_Technology_X")] == (1, ["13", "89", "G01S"])  # item name inside tech
    assert res[("D", "Sonar")] == (2, ["13", "89", "G01S"])           # first item of the domain
    assert res[("F", "Radar")] == (None, [])                          # unknown domain


def _brute_resolve(tech, items):
    """J1 restated over all pairs (test-only; the operator never forms them)."""
    out = {}
    for d, t in tech:
        cands = sorted((o, n, c) for dd, o, n, c in items if dd == d)
        best = None
        for tier, test in ((0, lambda n: n == t.strip()),
                           (1, lambda n: t in n or n in t),
                           (2, lambda n: True)):
            hit = [(o, c) for o, n, c in cands if test(n)]
            if hit:
                best = (tier, hit[0][1])
                break
        out[(d, t)] = best if best else (None, [])
    return out


def test_resolution_matches_brute_force(spark):
    """Names sharing prefixes, nested names, CJK, empty and untrimmed names."""
    names = ["智能", "智能驾驶", "智能驾驶决策", "驾驶", "src1", "src10", "src", "rc1",
             "a", "ab", "b a", "激光雷达", "雷达", "aa", "aaa", "雷达雷达"]
    items = [(d, o, n, [f"C{d}{o}"]) for d in ("D1", "D2") for o, n in enumerate(names)
             if (o + len(d)) % 3 != 0]
    techs = [(d, t) for d in ("D1", "D2", "D3")
             for t in names + ["", " 智能 ", "x智能驾驶y", "src101", "zz", "ba"]]
    it_df = spark.createDataFrame(items, "domain string, ord long, tech_name string, codes array<string>")
    t_df = spark.createDataFrame(techs, "domain string, tech_name_raw string")
    got = {(r["domain"], r["tech_name_raw"]): (r["resolution_tier"], r["expected_codes"])
           for r in resolve_expected(t_df, it_df).collect()}
    assert got == _brute_resolve(techs, items)


def test_items_of_late_part_files_resolve(spark):
    """An item's place may be any 64-bit integer (file rank * 2^33 + record)."""
    from taxograde.operators.mapping import resolve_expected
    tech = spark.createDataFrame([("D", "lidar"), ("D", "sonar"), ("E", "x")], "domain string, tech_name_raw string")
    for rank in (0, 127, 128, 200, 10 ** 6):
        items = spark.createDataFrame([("D", (rank << 33) + 5, "first", ["H01"]), ("D", (rank << 33) + 9, "lidar", ["G01S"])],
                                      "domain string, ord long, tech_name string, codes array<string>")
        got = {r["tech_name_raw"]: (r["resolution_tier"], r["item_ord"], r["expected_codes"])
               for r in resolve_expected(tech, items).collect()}
        assert got == {"lidar": (0, (rank << 33) + 9, ["G01S"]), "sonar": (2, (rank << 33) + 5, ["H01"]), "x": (None, None, [])}


def test_long_name_cell(spark):
    from taxograde.operators.mapping import resolve_expected
    tech = spark.createDataFrame([("D", "lidar")], "domain string, tech_name_raw string")
    items = spark.createDataFrame([("D", 1, "ab " * 6000 + "lidar", ["G01S"])],
                                  "domain string, ord long, tech_name string, codes array<string>")
    assert [r["resolution_tier"] for r in resolve_expected(tech, items).collect()] == [1]
