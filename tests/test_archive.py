"""Descriptor-driven archive loader on a literal fixture."""

import os

from valuescope.sources import archive

META = """<?xml version="1.0" encoding="UTF-8"?>
<archive xmlns="http://rs.tdwg.org/dwc/text/" metadata="eml.xml">
  <core encoding="UTF-8" fieldsTerminatedBy="\\t" linesTerminatedBy="\\n" fieldsEnclosedBy=""
        ignoreHeaderLines="2" rowType="http://rs.tdwg.org/dwc/terms/Occurrence">
    <files><location>occurrence.txt</location></files>
    <id index="0"/>
    <field index="1" term="http://rs.tdwg.org/dwc/terms/catalogNumber"/>
    <field index="2" term="http://ns.adobe.com/xap/1.0/rights/UsageTerms"/>
    <field term="http://rs.tdwg.org/dwc/terms/basisOfRecord" default="PreservedSpecimen"/>
  </core>
  <extension encoding="UTF-8" fieldsTerminatedBy="," linesTerminatedBy="\\n" fieldsEnclosedBy='"'
        ignoreHeaderLines="1" rowType="http://rs.tdwg.org/ac/terms/Multimedia">
    <files><location>multimedia.csv</location></files>
    <coreid index="0"/>
    <field index="1" term="http://rs.tdwg.org/ac/terms/accessURI"/>
  </extension>
  <extension encoding="UTF-8" fieldsTerminatedBy="\\t" linesTerminatedBy="\\n" fieldsEnclosedBy=""
        ignoreHeaderLines="0" rowType="http://example.org/Missing">
    <files><location>missing.txt</location></files>
    <coreid index="0"/>
    <field index="1" term="http://purl.org/dc/terms/x"/>
  </extension>
</archive>
"""

CORE = "\n".join([
    "id\tcatalogNumber\trights",
    "# second header line",
    "r1\tC-1\tCC0",
    "r2\tC-2",            # short row: dropped
    "",                   # blank row: skipped
    "r3\t\tCC-BY\textra",  # empty value absent, extra value ignored
]) + "\n"

MEDIA = 'coreid,accessURI\nr1,"http://x/1.jpg"\nr1,"http://x/a,b.jpg"\nr3,"say ""cheese"""\n'

EML = '<eml><dataset><title>Fixture</title></dataset></eml>\n'


def _write(folder):
    for name, text in [("meta.xml", META), ("occurrence.txt", CORE), ("multimedia.csv", MEDIA),
                       ("eml.xml", EML)]:
        with open(os.path.join(folder, name), "w") as f:
            f.write(text)


def test_archive_fixture(spark, tmp_dir):
    _write(tmp_dir)
    arc = archive.load_archive(spark, tmp_dir)
    assert arc.core.columns == ["id", "dwc:catalogNumber", "xmpRights:UsageTerms", "dwc:basisOfRecord"]
    core = sorted(tuple(r) for r in arc.core.collect())
    assert core == [("r1", "C-1", "CC0", "PreservedSpecimen"), ("r3", None, "CC-BY", "PreservedSpecimen")]
    assert len(arc.extensions) == 1  # the extension with a missing file is skipped
    media = sorted(tuple(r) for r in arc.extensions[0].collect())
    assert media == [("r1", "http://x/1.jpg"), ("r1", "http://x/a,b.jpg"), ("r3", 'say "cheese"')]
    joined = archive.join_core_extension(arc.core, arc.extensions[0])
    assert joined.count() == 3
    assert arc.metadata is not None and arc.metadata.first()["title"] == "Fixture"


def test_single_broken_extension_raises(spark, tmp_dir):
    _write(tmp_dir)
    meta = META.split("<extension")[0] + "<extension" + META.split("<extension")[2]
    with open(os.path.join(tmp_dir, "meta.xml"), "w") as f:
        f.write(meta)
    import pytest
    with pytest.raises(Exception):
        archive.load_archive(spark, tmp_dir, skip_eml=True)


def test_writer_reader_roundtrip(spark, tmp_dir):
    core = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    ext = spark.createDataFrame([(1, "x"), (1, "y")], "k int, w string")
    folder = os.path.join(tmp_dir, "arc")
    archive.write_archive(folder, core, "k", {"v": "http://rs.tdwg.org/dwc/terms/genus"},
                          [("ext", ext, "k", {"w": "http://purl.org/dc/terms/type"})])
    arc = archive.load_archive(spark, folder)
    assert sorted(tuple(r) for r in arc.core.collect()) == [("1", "a"), ("2", "b")]
    j = archive.join_core_extension(arc.core, arc.extensions[0])
    assert sorted((r["id"], r["dcterms:type"]) for r in j.collect()) == [("1", "x"), ("1", "y"), ("2", None)]


def test_location_by_suffix_and_undecodable_line(spark, tmp_dir):
    _write(tmp_dir)
    sub = os.path.join(tmp_dir, "data")
    os.makedirs(sub)
    os.rename(os.path.join(tmp_dir, "occurrence.txt"), os.path.join(sub, "x-occurrence.txt"))
    with open(os.path.join(sub, "x-occurrence.txt"), "ab") as f:
        f.write(bytes([0x72, 0x39, 0x09, 0xFF, 0xFE, 0x09, 0x43, 0x43, 0x30, 0x0A]))  # r9 <bad> CC0
        f.write("r8\tok\tCC0\n".encode())
    arc = archive.load_archive(spark, tmp_dir, skip_eml=True)
    ids = sorted(r["id"] for r in arc.core.collect())
    assert ids == ["r1", "r3", "r8"]


def test_any_text_survives_an_archive(spark, tmp_dir):
    texts = [" a", "a ", " ", "x\ny", "x\r\ny", "\\n", "tab\there", 'q"u', "end\\", "\ufeff"]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, t string")
    folder = os.path.join(tmp_dir, "arc")
    archive.write_archive(folder, df, "id", {"t": "http://rs.tdwg.org/dwc/terms/occurrenceRemarks"})
    core = archive.load_archive(spark, folder).core
    assert sorted((int(r["id"]), r["dwc:occurrenceRemarks"]) for r in core.collect()) == list(enumerate(texts))


def test_other_encodings_lose_nothing(spark, tmp_dir):
    for encoding in ("ISO-8859-1", "UTF-16LE"):
        path = os.path.join(tmp_dir, encoding)
        with open(path, "wb") as f:
            f.write("1\tcaf\u00e9\x01rest\n2\t\"x\"\r\n".encode(encoding))
        rows = [r["value"] for r in archive._read_lines(spark, path, encoding, "\n").collect()]
        assert rows == ["1\tcaf\u00e9\x01rest", '2\t"x"']
