"""Files of several encodings, separators and columns, and workbooks, read on executors."""

import zipfile

import pytest

from tidewell.sources import files, io


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def workbook(path, cells, shared=(), styles=""):
    """A small xlsx: rows of (reference, type, value, style)."""
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    line = lambda row: "<row>" + "".join(f'<c r="{r}" t="{t}" s="{s}">' + (f"<is><t>{v}</t></is>" if t == "inlineStr" else f"<v>{v}</v>") + "</c>" for r, t, v, s in row) + "</row>"
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook {ns} xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets><sheet name="one" sheetId="1" r:id="rId7"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId7" Target="worksheets/data.xml"/></Relationships>')
        z.writestr("xl/worksheets/data.xml", f"<worksheet {ns}><sheetData>{''.join(map(line, cells))}</sheetData></worksheet>")
        if shared:
            z.writestr("xl/sharedStrings.xml", f"<sst {ns}>" + "".join(f"<si><r><t>{s[:1]}</t></r><r><t>{s[1:]}</t></r></si>" for s in shared) + "</sst>")
        if styles:
            z.writestr("xl/styles.xml", f"<styleSheet {ns}>{styles}</styleSheet>")


def test_four_encodings_in_one_read(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("Name,Größe (m)\nJosé,1\nNA,\n".encode())
    (tmp_path / "b.csv").write_bytes("\ufeffname,Größe (m)\n“x”,2\n".encode())
    (tmp_path / "c.csv").write_bytes("name,größe (m)\n“Žluť”,3\n".encode("cp1252", "replace"))
    (tmp_path / "d.csv").write_bytes(b"name,extra\nab\x81\xe9,4\n")
    (tmp_path / "e.csv").write_bytes("name\textra\nü\t5\n".encode("utf-16"))
    (tmp_path / "f.csv").write_bytes(b'name,extra\n"two\nlines, and ""quotes""",6,beyond\nshort\n\n')
    (tmp_path / "g.csv").write_bytes(b"")
    got = files.text_tables(spark, str(tmp_path / "*.csv"))
    assert got.columns == ["name", "größe_m", "extra"]
    want = [("José", "1", None), (None, None, None), ("“x”", "2", None), ("“Žlu?”", "3", None), ("ab\x81é", None, "4"), ("ü", None, "5"), ('two\nlines, and "quotes"', None, "6"), ("short", None, None)]
    assert rows(got) == sorted(want, key=str)
    assert {r.file.rsplit("/", 1)[1] for r in files.text_tables(spark, str(tmp_path / "[ab].csv"), with_path="file").collect()} == {"a.csv", "b.csv"}
    assert rows(io.csv(spark, str(tmp_path / "[ab].csv"))) == sorted([("José", "1"), (None, None), ("“x”", "2")], key=str)
    assert rows(io.csv(spark, str(tmp_path / "b.csv"), encoding="UTF-8")) == [("“x”", "2")]
    assert files.text_tables(spark, str(tmp_path / "g.csv")).count() == 0


def test_encodings():
    assert [files.decoded(x)[1] for x in (b"a", b"\xef\xbb\xbfa", "é".encode(), b"\x93a", b"\x81", b"\xff\xfea\0", b"\xff\xfea")] == ["utf-8", "utf-8-sig", "utf-8", "cp1252", "latin-1", "utf-16", "cp1252"]
    big = ('a,b\n"' + "x" * 300_000 + '",1\n').encode()
    assert [len(c) for c in list(files.text_rows(big))[1]] == [300_000, 1]


def test_workbooks(spark, tmp_path):
    dates = '<numFmts><numFmt numFmtId="170" formatCode="dd\\.mm\\.yy"/><numFmt numFmtId="171" formatCode="0.0&quot;d&quot;"/></numFmts><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/><xf numFmtId="170"/><xf numFmtId="171"/></cellXfs>'
    workbook(tmp_path / "s.xlsx", [[("A1", "s", 0, 0), ("C1", "s", 1, 0), ("D1", "inlineStr", "Day", 0)], [("A2", "n", "1.5", 0), ("C2", "b", "1", 0), ("D2", "n", "45000.25", 1)], [], [("A4", "inlineStr", "n/a", 0), ("B4", "str", "mid", 0), ("D4", "n", "1", 3)]], ["State (x)", "Open"], dates)
    workbook(tmp_path / "s_b.xlsx", [[("A1", "inlineStr", "open", 0), ("B1", "inlineStr", "Other", 0)], [("A2", "inlineStr", "no", 0), ("B2", "n", "45000", 2)]], styles=dates)
    got = files.workbooks(spark, str(tmp_path / "*.xlsx"))
    assert got.columns == ["state_x", "column_2", "open", "day", "other"]
    assert rows(got) == sorted([("1.5", None, "True", "2023-03-15 06:00:00", None), (None, "mid", None, "1", None), (None, None, "no", None, "2023-03-15 00:00:00")], key=str)
    manual = io.manual(spark, str(tmp_path), "s")
    assert manual.count() == 3 and "open" in manual.columns
    (tmp_path / "bad.xlsx").write_bytes(b"no workbook")
    with pytest.raises(Exception, match="bad.xlsx"):
        files.workbooks(spark, str(tmp_path / "bad.xlsx"))
