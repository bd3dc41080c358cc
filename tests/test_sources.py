"""File fixtures written by the test itself (fresh folder per run)."""

import json
import os

import pytest

from taxograde.operators.patents import clean_patents
from taxograde.sources import inputs


def _w(path, data, enc="utf-8"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(data.encode(enc) if isinstance(data, str) else data)


def test_patent_files(spark, tmpdir_fresh):
    root = os.path.join(tmpdir_fresh, "patents")
    _w(f"{root}/A/x.csv", "title,abstract\nt1,a1\n,\n   \nNA,a2\n")
    _w(f"{root}/A/y.csv", "patent id,title,abstract\n7,\"t 2\",\"multi\nline\"\n,t3,a3\n")
    _w(f"{root}/A/empty.csv", "title,abstract\n")
    _w(f"{root}/传感/a b%c.csv", "﻿title,abstract\n标题,摘要\n")
    _w(f"{root}/A/g.csv", "title,abstract\n标题,摘要\n", enc="gb18030")
    _w(f"{root}/Z/z.csv", "title,abstract\nq,r\n")  # domain not in the hierarchy
    pf = inputs.read_patents(spark, root, ["A", "传感", "Missing"])
    assert sorted(pf.missing_domains) == ["Missing"]
    tech = sorted(tuple(r) for r in pf.tech.collect())
    assert tech == [("A", "empty"), ("A", "g"), ("A", "x"), ("A", "y"), ("传感", "a b%c")]
    clean = clean_patents(pf.rows, "title", "abstract", "patent_id")
    got = sorted((r["tech_name_raw"], r["patent_id"], r["title"], r["abstract"]) for r in clean.collect())
    assert got == sorted([
        ("x", "x-0", "t1", "a1"), ("x", "x-1", "", "a2"),
        ("y", "7", "t 2", "multi\nline"), ("y", "nan", "t3", "a3"),
        ("a b%c", "a b%c-0", "标题", "摘要"),
        ("g", "g-0", "标题", "摘要"),
    ])


def test_missing_column_raises(spark, tmpdir_fresh):
    root = os.path.join(tmpdir_fresh, "patents")
    _w(f"{root}/A/bad.csv", "title,summary\nx,y\n")
    with pytest.raises(ValueError, match="missing column: abstract"):
        inputs.read_patents(spark, root, ["A"])


def test_mapping_files(spark, tmpdir_fresh):
    mroot = os.path.join(tmpdir_fresh, "mappings")
    _w(f"{mroot}/D1.csv", "技术名称,IPC\nRadar,\"G01S 13/89, G01S\"\nLidar,G01S17\n")
    _w(f"{mroot}/D1_old.csv", "技术名称,IPC\nRadar,H99\n")
    _w(f"{mroot}/D2_v2.csv", "Technology Code\nB60W\n")
    _w(f"{mroot}/D3.csv", "foo,bar\nthing,X01;Y02\n", enc="gb18030")
    ts = os.path.join(tmpdir_fresh, "techset.json")
    _w(ts, json.dumps({"domains": ["D1", "D2", "D3", "D4"]}))
    t = inputs.read_techset(spark, ts)
    assert t.domains == ["D1", "D2", "D3", "D4"] and t.items == []
    chosen = inputs.detect_mapping(spark, mroot, t.domains_df(spark))
    names = {r["domain"]: r["name"] for r in chosen.collect()}
    assert names == {"D1": "D1.csv", "D2": "D2_v2.csv", "D3": "D3.csv"}
    items = inputs.read_mapping_items(spark, chosen)
    got = sorted((r["domain"], r["tech_name"], tuple(r["codes"])) for r in items.collect())
    assert got == [("D1", "Lidar", ("G01S17",)), ("D1", "Radar", ("13", "89", "G01S")),
                   ("D2", "B60W", ("B60W",)), ("D3", "thing", ("X01", "Y02"))]


def test_default_domains(spark, tmpdir_fresh):
    ts = os.path.join(tmpdir_fresh, "t.json")
    _w(ts, json.dumps({"items": []}))
    assert inputs.read_techset(spark, ts).domains == ["环境感知", "决策规划", "控制执行", "支撑体系"]


def test_write_bytes_through_hadoop_filesystem(spark, tmpdir_fresh, monkeypatch):
    """A shared folder on another filesystem is written through Hadoop's API."""
    import taxograde.session as S
    monkeypatch.setattr(S, "_is_remote", lambda p: True)
    target = f"file://{tmpdir_fresh}/pyfiles/x.zip"
    S.write_bytes(spark, target, b"PK\x03\x04\x00\xff")
    with open(f"{tmpdir_fresh}/pyfiles/x.zip", "rb") as f:
        assert f.read() == b"PK\x03\x04\x00\xff"


def _xlsx(rows):
    """A minimal workbook (first sheet only): strings go to the shared table,
    ('inline', s) is an inline string, ('bool', b) a boolean, numbers as is."""
    import io
    import zipfile
    from xml.sax.saxutils import escape
    shared, cells_xml = [], []
    for r, row in enumerate(rows, start=1):
        cells = []
        for c, v in enumerate(row):
            ref = f"{chr(ord('A') + c)}{r}"
            if v is None:
                continue
            if isinstance(v, tuple) and v[0] == "inline":
                cells.append(f'<c r="{ref}" t="inlineStr"><is><r><t>{escape(v[1][:2])}</t></r>'
                             f'<r><t>{escape(v[1][2:])}</t></r></is></c>')
            elif isinstance(v, tuple) and v[0] == "bool":
                cells.append(f'<c r="{ref}" t="b"><v>{int(v[1])}</v></c>')
            elif isinstance(v, str):
                shared.append(v)
                cells.append(f'<c r="{ref}" t="s"><v>{len(shared) - 1}</v></c>')
            else:
                cells.append(f'<c r="{ref}"><v>{v}</v></c>')
        cells_xml.append(f'<row r="{r}">{"".join(cells)}</row>')
    main = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook xmlns="{main}" xmlns:r="{rel}"><sheets>'
                                      f'<sheet name="M" sheetId="1" r:id="rId7"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels",
                   '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
                   '<Relationship Id="rId7" Target="worksheets/data.xml"/></Relationships>')
        z.writestr("xl/worksheets/data.xml",
                   f'<worksheet xmlns="{main}"><sheetData>{"".join(cells_xml)}</sheetData></worksheet>')
        z.writestr("xl/sharedStrings.xml",
                   f'<sst xmlns="{main}">' + "".join(f"<si><t>{escape(s)}</t></si>" for s in shared)
                   + "</sst>")
    return buf.getvalue()


def test_spreadsheet_and_missing_cells(spark, tmpdir_fresh):
    """.xlsx mappings are read (first sheet); cells read as missing give no
    name and no code, in spreadsheets and CSV files alike."""
    mroot = os.path.join(tmpdir_fresh, "mappings")
    _w(f"{mroot}/D1.xlsx", _xlsx([
        ["编号", "技术名称", "IPC", None],
        [1, "Radar", "G01S 13/89, G01S", "x"],
        [2, "NULL", "H01", None],
        [3, ("inline", "Lidar"), "NA", 17],
        [4, "Sonar", 17, None],
        [5, "Camera", ("bool", True), None],
    ]))
    _w(f"{mroot}/D1.csv", "技术名称,IPC\nIgnored,X99\n")   # .xlsx ranks first
    _w(f"{mroot}/D2.csv", "技术名称,IPC\nRadar,N/A\nnull,G01\nLidar,\"G01S17;n/a\"\n")
    ts = os.path.join(tmpdir_fresh, "techset.json")
    _w(ts, json.dumps({"domains": ["D1", "D2"]}))
    t = inputs.read_techset(spark, ts)
    chosen = inputs.detect_mapping(spark, mroot, t.domains_df(spark))
    assert {r["domain"]: r["name"] for r in chosen.collect()} == {"D1": "D1.xlsx", "D2": "D2.csv"}
    items = inputs.read_mapping_items(spark, chosen)
    got = sorted((r["domain"], r["ord"] % (1 << 33), r["tech_name"], tuple(r["codes"]))
                 for r in items.collect())
    assert got == [("D1", 1, "Radar", ("13", "89", "G01S")), ("D1", 4, "Sonar", ("17",)),
                   ("D1", 5, "Camera", ("TRUE",)),
                   ("D2", 2, "Lidar", ("A", "G01S17", "N"))]  # "/" splits "n/a"


def test_sheet_header_names():
    from taxograde.sources.sheets import header_names
    assert header_names(["a", None, "a", "", "a"]) == ["a", "Unnamed: 1", "a.1", "Unnamed: 3", "a.2"]


def test_csv_reader_rules(spark, tmpdir_fresh):
    """Blank lines, late headers, short and ragged records as the original's reader has them."""
    root = os.path.join(tmpdir_fresh, "patents")
    _w(f"{root}/A/blank.csv", "\n  \ntitle,abstract\nt1,a1\n\n   ,\nt2\n")
    wide = ",".join(f"c{i}" for i in range(20_000))
    _w(f"{root}/A/wide.csv", f"{wide},title,abstract\n{',' * 20_000}t3,a3\n")
    pf = inputs.read_patents(spark, root, ["A"])
    got = {(r["tech_name_raw"], r["ord"], r["title"], r["abstract"]) for r in pf.rows.collect()}
    assert got == {("blank", 0, "t1", "a1"), ("blank", 1, "   ", None), ("blank", 2, "t2", None), ("wide", 0, "t3", "a3")}
    bad = os.path.join(tmpdir_fresh, "ragged")
    _w(f"{bad}/A/r.csv", "title,abstract\na,b\nc,d,e,f\n")
    with pytest.raises(Exception, match="Expected 2 fields"):
        inputs.read_patents(spark, bad, ["A"]).rows.collect()


def test_mapping_with_semicolons(spark, tmpdir_fresh):
    mroot = os.path.join(tmpdir_fresh, "mappings")
    _w(f"{mroot}/D.csv", "tech;codes\nradar;G01S\nlidar;G01S 17/89,H04W,B60\n")
    chosen = inputs.detect_mapping(spark, mroot, spark.createDataFrame([(1, "D")], "domain_pos long, domain string"))
    got = {r["tech_name"]: r["codes"] for r in inputs.read_mapping_items(spark, chosen).collect()}
    assert got == {"radar": ["G01S"], "lidar": ["17", "89", "B60", "G01S", "H04W"]}


def test_large_hierarchy_and_cluster_without_shared_folder(spark, tmpdir_fresh):
    ts = os.path.join(tmpdir_fresh, "big.json")
    _w(ts, json.dumps({"domains": ["D"], "items": ["x" * 2_000_000]}))
    assert len(inputs.read_techset(spark, ts).text) > 2_000_000


def test_large_file_is_split_and_keeps_its_order(spark, tmpdir_fresh):
    """A file whose records end with their lines is read by many tasks; ``ord`` is in file order."""
    root = os.path.join(tmpdir_fresh, "patents")
    n = 3000
    _w(f"{root}/A/big.csv", "title,abstract\n" + "".join(f"t{i},\"a, {i} \"\"q\"\"\"\n\n" for i in range(n)))
    _w(f"{root}/A/small.csv", "abstract,title\nb,a\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        rows = inputs.read_patents(spark, root, ["A"]).rows
        assert rows.rdd.getNumPartitions() > 8
        got = sorted((r["ord"], r["title"], r["abstract"]) for r in rows.where("tech_name_raw = 'big'").collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert [t for _, t, _ in got] == [f"t{i}" for i in range(n)] and len({o for o, _, _ in got}) == n
    assert {a for _, _, a in got} == {f'a, {i} "q"' for i in range(n)}


def test_records_over_several_lines(spark, tmpdir_fresh):
    root = os.path.join(tmpdir_fresh, "patents")
    _w(f"{root}/A/m.csv", 'title,abstract\n"t\n1",a\n   \n\nt2\n"t""3","a,\n\n b"\n')
    got = sorted(tuple(r) for r in inputs.read_patents(spark, root, ["A"]).rows.select("ord", "title", "abstract").collect())
    assert [r[1:] for r in got] == [("t\n1", "a"), ("t2", None), ('t"3', "a,\n\n b")]
    _w(f"{root}/A/late.csv", '  \ntitle,abstract\n"x\ny",z\n')
    got = {tuple(r) for r in inputs.read_patents(spark, root, ["A"]).rows.where("tech_name_raw = 'late'").select("title", "abstract").collect()}
    assert got == {("x\ny", "z")}
    _w(f"{root}/B/bad.csv", 'title,abstract\n"t\n1",a,b\n')
    with pytest.raises(Exception, match="Expected 2 fields"):
        inputs.read_patents(spark, root, ["B"]).rows.collect()


def test_file_names_that_look_like_patterns(spark, tmpdir_fresh):
    root = os.path.join(tmpdir_fresh, "patents")
    _w(f"{root}/A/a[1]{{x}}.csv", "title,abstract\nt,a\n")
    _w(f"{root}/A/a1.csv", "title,abstract\nu,b\n")
    got = {tuple(r) for r in inputs.read_patents(spark, root, ["A"]).rows.select("tech_name_raw", "title").collect()}
    assert got == {("a[1]{x}", "t"), ("a1", "u")}


def test_versions(spark, tmpdir_fresh, monkeypatch):
    """The newest rows of each group; few folders whatever the number of groups and writes; a dead write is not seen."""
    from pyspark.sql.types import LongType, StringType, StructField, StructType
    from taxograde.sources import versions as V
    monkeypatch.setattr(V, "MAX_VERSIONS", 3)
    schema = StructType([StructField("k", StringType()), StructField("v", LongType())])
    path = f"{tmpdir_fresh}/table"
    want = {}
    for n in range(8):
        rows = [(f"k{i}", n * 100 + i) for i in range(n, n + 4)]
        V.write_groups(spark.createDataFrame(rows, schema), path, schema, ["k"])
        want.update(dict(rows))
        os.makedirs(f"{path}/version={1000}", exist_ok=True)  # of a write that has not finished
        assert {r["k"]: r["v"] for r in V.read_latest(spark, path, schema, ["k"]).collect()} == want
        assert len(V.versions(spark, path)) <= 4
    assert V.read_latest(spark, f"{tmpdir_fresh}/none", schema, ["k"]).count() == 0


def test_unreadable_state_files(spark, tmpdir_fresh):
    """A truncated file is skipped when it is read, and reported; the rest counts."""
    import glob

    from taxograde.operators import inference, resume
    from taxograde.sources.tolerant import unreadable_files
    ck, cache = f"{tmpdir_fresh}/ck", f"{tmpdir_fresh}/cache"
    for name in ("a", "b"):
        resume.mark_done(spark.createDataFrame([("D", name)], "domain string, tech_name_raw string").coalesce(1), ck)
    key = {n: f"{i}{i}" + n for i, n in enumerate("xyz")}
    for n in "xyz":
        inference.append_cache(spark.createDataFrame([(key[n], '{"patent_batches":[]}', None)],
                                                     "cache_key string, response string, error string"), cache)
    assert unreadable_files(spark, ck, resume.SCHEMA).count() == 0

    def truncate(path):
        with open(path, "rb") as f:
            data = f.read()
        with open(path, "wb") as f:
            f.write(data[:len(data) // 2])
        crc = os.path.join(os.path.dirname(path), "." + os.path.basename(path) + ".crc")
        if os.path.exists(crc):
            os.remove(crc)
    bad = sorted(glob.glob(f"{ck}/*.parquet"))[0]
    gone = spark.read.parquet(bad).first()["tech_name_raw"]
    truncate(bad)
    left = {"a", "b"} - {gone}
    assert {r["tech_name_raw"] for r in resume.read_checkpoints(spark, ck).collect()} == left
    report = unreadable_files(spark, ck, resume.SCHEMA).collect()
    assert len(report) == 1 and os.path.basename(bad) in report[0]["file"] and report[0]["error"]
    tech = spark.createDataFrame([("D", "a"), ("D", "b")], "domain string, tech_name_raw string")
    assert {r["tech_name_raw"] for r in resume.skip_done(tech, resume.read_checkpoints(spark, ck)).collect()} == {gone}
    truncate(glob.glob(f"{cache}/key_prefix=11/*.parquet")[0])
    spark.createDataFrame([("33bad", "not json", "33")], inference.CACHE_SCHEMA).write.mode("append").partitionBy("key_prefix").parquet(cache)
    requests = spark.createDataFrame([(k,) for k in [*key.values(), "33bad"]], "cache_key string")
    hits, misses = inference.split_cached(requests, inference.read_cache(spark, cache, requests))
    assert {r["cache_key"] for r in hits.collect()} == {key["x"], key["z"]}
    assert {r["cache_key"] for r in misses.collect()} == {key["y"], "33bad"}
    inference.append_cache(requests.selectExpr("cache_key", "'{\"patent_batches\":[]}' as response", "cast(null as string) as error"), cache)
    assert inference.split_cached(requests, inference.read_cache(spark, cache, requests))[1].count() == 0


def test_files_of_a_write_that_never_finished_hold_nothing(spark, tmpdir_fresh):
    from taxograde.sources.tolerant import read_tolerant
    assert read_tolerant(spark, f"{tmpdir_fresh}/none", "a string").count() == 0
    assert read_tolerant(spark, None, "a string").count() == 0
