import json
import os

import pytest

from featuremap.errors import SourceError
from featuremap.sources import (CSVDestination, CSVSource, ExcelDestination, ExcelSource,
                                JSONArrayDestination, JSONArraySource, JSONDestination, JSONSource)
from featuremap.sources.workbook import write_workbook


def test_csv_scan_types(spark, tmp_dir):
    p = os.path.join(tmp_dir, "a.csv")
    with open(p, "w") as f:
        f.write("name,age,score,when,flag\nAlice,25,85.5,2024-01-01,True\nBob,NA,90.0,2024-01-02,False\n"
                "Carol,35,,2024-01-03,true\n")
    df = CSVSource(p).extract(spark)
    assert dict(df.dtypes) == {"name": "string", "age": "bigint", "score": "double",
                               "when": "string", "flag": "boolean"}
    rows = df.orderBy("name").collect()
    assert rows[1].age is None and rows[2].score is None


def test_csv_forced_type_and_errors(spark, tmp_dir):
    p = os.path.join(tmp_dir, "b.csv")
    with open(p, "w") as f:
        f.write("a,b\n1,x\n2,y\n")
    assert dict(CSVSource(p, schema_overrides={"a": "string"}).extract(spark).dtypes)["a"] == "string"
    with pytest.raises(SourceError):
        CSVSource(os.path.join(tmp_dir, "missing.csv")).extract(spark)


def test_json_records_and_lines(spark, tmp_dir):
    p = os.path.join(tmp_dir, "r.json")
    with open(p, "w") as f:
        json.dump([{"a": 1, "b": "x"}, {"a": 2, "b": "y"}], f)
    df = JSONSource(p).extract(spark)
    assert sorted(r.a for r in df.collect()) == [1, 2]
    bad = os.path.join(tmp_dir, "bad.json")
    with open(bad, "w") as f:
        f.write("[{not json")
    with pytest.raises(Exception):
        JSONSource(bad).extract(spark).collect()


def test_csv_json_overwrite_roundtrip(spark, tmp_dir):
    out = os.path.join(tmp_dir, "nested", "out")
    CSVDestination(out).save(spark.createDataFrame([(1,)], ["a"]))
    CSVDestination(out).save(spark.createDataFrame([(1,), (2,), (3,)], ["a"]))
    assert CSVSource(out).extract(spark).count() == 3
    jout = os.path.join(tmp_dir, "j")
    JSONDestination(jout).save(spark.createDataFrame([(1, "x")], ["a", "b"]))
    assert JSONSource(jout, lines=True).extract(spark).first().b == "x"


def parts(path):
    return "".join(open(os.path.join(path, f)).read() for f in sorted(os.listdir(path)) if f.startswith("part-"))


@pytest.mark.parametrize("n", [0, 1, 7, 500])
def test_json_array_is_one_document_and_reads_back(spark, tmp_dir, n):
    rows = [(i, None if i % 3 == 0 else f'a "quoted", [text]\n]\n[ {i}', [i / 2]) for i in range(n)]
    df = spark.createDataFrame(rows, "`a.b` long, t string, v array<double>").repartition(5)
    out = os.path.join(tmp_dir, f"array{n}")
    JSONArrayDestination(out).save(df)
    JSONArrayDestination(out, indent=4).save(df)                 # overwrites
    text = parts(out)
    assert sorted((r["a.b"], r["t"], r["v"]) for r in json.loads(text)) == sorted(rows)
    assert n < 2 or '\n    {"a.b"' in text
    if not n:
        with pytest.raises(SourceError):
            JSONArraySource(out).extract(spark)
    back = JSONArraySource(out, schema=df.schema).extract(spark)
    assert sorted(map(tuple, back.collect())) == sorted(rows) and back.count() == n


def test_json_array_keeps_the_order_of_rows(spark, tmp_dir):
    out = os.path.join(tmp_dir, "ordered")
    JSONArrayDestination(out).save(spark.range(1000, numPartitions=6).orderBy("id"))
    assert [r["id"] for r in json.loads(parts(out))] == list(range(1000))


def test_json_array_with_a_broken_line(spark, tmp_dir):
    p = os.path.join(tmp_dir, "broken.json")
    with open(p, "w") as f:
        f.write('[\n  {"a": 1},\n  {"a": 2\n]\n')
    with pytest.raises(Exception, match="Could not parse"):
        JSONArraySource(p).extract(spark).collect()
    with pytest.raises(SourceError):
        JSONArraySource(os.path.join(tmp_dir, "none.json")).extract(spark)


def test_csv_without_header_chosen_columns_and_dates(spark, tmp_dir):
    p = os.path.join(tmp_dir, "bare.csv")
    with open(p, "w") as f:
        f.write("# exported\n1,x,2024-01-02\n2,NA,2024-01-03 04:05:06\n")
    df = CSVSource(p, header=False, comment="#").extract(spark)
    assert df.columns == ["0", "1", "2"] and dict(df.dtypes)["0"] == "bigint" and df.count() == 2
    df = CSVSource(p, header=False, comment="#", names=["a.b", "n", "d"], columns=["d", "a.b"],
                   dates=["d"]).extract(spark)
    assert df.dtypes == [("d", "timestamp"), ("a.b", "bigint")]
    assert sorted(str(r.d) for r in df.collect()) == ["2024-01-02 00:00:00", "2024-01-03 04:05:06"]
    for bad in ({"names": ["a"]}, {"columns": ["zz"]}, {"dates": ["zz"]}):
        with pytest.raises(SourceError):
            CSVSource(p, header=False, comment="#", **bad).extract(spark)


def test_csv_dates_that_are_none_raise(spark, tmp_dir):
    p = os.path.join(tmp_dir, "dates.csv")
    with open(p, "w") as f:
        f.write("d,n\n2024-01-02,1\nyesterday,2\n")
    with pytest.raises(Exception):
        CSVSource(p, dates=["d"]).extract(spark).collect()


def test_workbook_sheets(spark, tmp_dir):
    p = os.path.join(tmp_dir, "book.xlsx")
    write_workbook(p, "First", ["a", "b"], [(1, "x"), (2, "y")])
    df = ExcelSource(p, sheet_name="First").extract(spark)
    assert dict(df.dtypes) == {"a": "bigint", "b": "string"}
    assert sorted(r.a for r in df.collect()) == [1, 2]
    assert ExcelSource(p, sheet_name=0).extract(spark).count() == 2
    with pytest.raises(Exception):
        ExcelSource(p, sheet_name="Nope").extract(spark).collect()


def test_workbook_write_partitions_and_overwrite(spark, tmp_dir):
    out = os.path.join(tmp_dir, "books")
    df = spark.createDataFrame([(i, f"n{i}", i * 1.5) for i in range(50)], ["id", "name", "v"])
    ExcelDestination(out, sheet_name="S").save(df.repartition(3))
    ExcelDestination(out, sheet_name="S").save(df.repartition(2))
    files = [f for f in os.listdir(out) if f.endswith(".xlsx")]
    assert len(files) == 2
    back = ExcelSource(out, sheet_name="S").extract(spark)
    assert back.count() == 50 and dict(back.dtypes)["v"] == "double"


def test_csv_ragged_row_is_a_source_error(spark, tmp_dir):
    p = os.path.join(tmp_dir, "ragged.csv")
    with open(p, "w") as f:
        f.write("a,b\n1,2\n3,4,5\n")
    with pytest.raises(SourceError):
        CSVSource(p).extract(spark)


def _two_sheet_book(path):
    """A workbook as office suites write it: shared strings, two sheets."""
    import zipfile

    main = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    pkg = "http://schemas.openxmlformats.org/package/2006/relationships"
    sheet = ('<worksheet xmlns="%s"><sheetData>'
             '<row r="1"><c r="A1" t="s"><v>%d</v></c></row>'
             '<row r="2"><c r="A2"><v>%s</v></c></row>'
             '<row r="3"><c r="A3"><v>%s</v></c></row></sheetData></worksheet>')
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("xl/workbook.xml",
                   f'<workbook xmlns="{main}" xmlns:r="{rel}"><sheets>'
                   '<sheet name="First" sheetId="1" r:id="rId1"/>'
                   '<sheet name="Second" sheetId="2" r:id="rId2"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels",
                   f'<Relationships xmlns="{pkg}">'
                   '<Relationship Id="rId1" Type="ws" Target="worksheets/sheet1.xml"/>'
                   '<Relationship Id="rId2" Type="ws" Target="/xl/worksheets/sheet2.xml"/>'
                   '</Relationships>')
        z.writestr("xl/sharedStrings.xml",
                   f'<sst xmlns="{main}"><si><t>a</t></si><si><r><t>b</t></r></si></sst>')
        z.writestr("xl/worksheets/sheet1.xml", sheet % (main, 0, "1", "2"))
        z.writestr("xl/worksheets/sheet2.xml", sheet % (main, 1, "3.5", "4"))


def test_workbook_shared_strings_two_sheets(spark, tmp_dir):
    p = os.path.join(tmp_dir, "two.xlsx")
    _two_sheet_book(p)
    first = ExcelSource(p, sheet_name="First").extract(spark)
    assert first.columns == ["a"] and sorted(r.a for r in first.collect()) == [1, 2]
    second = ExcelSource(p, sheet_name=1).extract(spark)
    assert second.columns == ["b"] and sorted(r.b for r in second.collect()) == [3.5, 4.0]
