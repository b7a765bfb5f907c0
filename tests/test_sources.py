import gzip
import io
import tarfile
import zipfile

from cohortloom.sources import gtf, soft, tabular

SOFT = """^SERIES = GSE1
!Series_title = A study
!Series_relation = SuperSeries of: GSE2
!Series_relation = BioProject: x
!Series_supplementary_file = ftp://h/a.txt.gz
!Series_supplementary_file = NONE
^SAMPLE = GSM1
!Sample_characteristics_ch1 = sex: F
!Sample_characteristics_ch1 = age: 3
!Sample_supplementary_file_1 = ftp://h/GSM1.CEL.gz
!sample_table_begin
ID_REF\tVALUE
p1\t1.5
p2\tnull
!sample_table_end
"""


def test_soft(spark, tmp_path):
    (tmp_path / "a_family.soft.gz").write_bytes(gzip.compress(SOFT.encode()))
    meta = soft.read_metadata(spark, str(tmp_path)).cache()
    assert {(r.key, r.ord, r.value) for r in meta.where("entity = 'SAMPLE' and key like 'char%'").collect()} == {("characteristics_ch1", 0, "sex: F"), ("characteristics_ch1", 1, "age: 3")}
    assert {tuple(r) for r in soft.series_relations(meta).collect()} == {("GSE1", "GSE2")}
    assert {r.url for r in soft.supplementary_urls(meta).collect()} == {"https://h/a.txt.gz", "https://h/GSM1.CEL.gz"}
    assert [tuple(r) for r in soft.scan_files(meta).collect()] == [("GSM1", "ftp://h/GSM1.CEL.gz")]
    assert soft.sample_characteristics(meta).first()["lines"] == ["sex: F", "age: 3"]
    assert {tuple(r) for r in soft.probe_cells(soft.read_tables(spark, str(tmp_path))).collect()} == {("GSE1", "GSM1", "p1", 1.5), ("GSE1", "GSM1", "p2", None)}


def test_tables_and_archives(spark, tmp_path):
    table = b"# note\nid;s1;s2\ng1;1,5;NA\ng2;2;3\n"
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("m.csv", table)
    with tarfile.open(tmp_path / "b.tar.gz", "w:gz") as t:
        info = tarfile.TarInfo("n.tsv.gz")
        data = gzip.compress(b"id\ts1\ng1\t7\n")
        info.size = len(data)
        t.addfile(info, io.BytesIO(data))
    (tmp_path / "c.tar").write_bytes(b"broken")
    rows = tabular.read_rows(spark, str(tmp_path)).cache()
    assert rows.where("error is not null").select("member").count() == 1
    got = {(r.member, r.feature_id, r.sample_id, r.value) for r in tabular.matrix_cells(rows).collect()}
    assert got == {("m.csv", "g1", "s1", None), ("m.csv", "g1", "s2", None), ("m.csv", "g2", "s1", 2.0), ("m.csv", "g2", "s2", 3.0), ("n.tsv.gz", "g1", "s1", 7.0)}
    assert {r.member for r in tabular.member_list(spark, str(tmp_path)).collect()} == {"m.csv", "n.tsv.gz"}
    assert tabular.sniff_delimiter("a,b\nc,d") == "," and tabular.sniff_delimiter("") == "\t"


def test_workbook():
    book = io.BytesIO()
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    with zipfile.ZipFile(book, "w") as z:
        z.writestr("xl/sharedStrings.xml", f"<sst {ns}><si><t>id</t></si><si><t>s1</t></si></sst>")
        z.writestr("xl/worksheets/sheet1.xml", f'<worksheet {ns}><sheetData><row><c r="A1" t="s"><v>0</v></c><c r="C1" t="s"><v>1</v></c></row><row><c r="A2"><v>5</v></c></row></sheetData></worksheet>')
    assert list(tabular.workbook_rows(book.getvalue())) == [["id", "", "s1"], ["5"]]


def test_gtf(spark, tmp_path):
    lines = ['chrX\tH\tgene\t1\t9\t.\t+\t.\tgene_id "G1"; gene_type "protein_coding"; gene_name "A"; tag "t1"; tag "t2";', 'chrY\tH\tgene\t1\t9\t.\t+\t.\tgene_id "G2"; gene_type "x"; gene_name "A";', 'chr1\tH\ttranscript\t1\t50\t.\t+\t.\tgene_id "G3"; transcript_id "T1"; gene_name "B"; gene_type "p"; transcript_type "p"; ccdsid "C1";']
    lines += [f'chr1\tH\texon\t{a}\t{b}\t.\t+\t.\tgene_id "G3"; transcript_id "T1";' for a, b in ((1, 10), (21, 25))]
    (tmp_path / "a.gtf").write_text("#c\n" + "\n".join(lines))
    read = gtf.read_lines(spark, str(tmp_path))
    assert [(r.gene_id, r.gene_tags) for r in gtf.genes(read).collect()] == [("G1", "t1,t2")]
    assert [(r.transcript_id, r.transcript_length, r.ccdsid) for r in gtf.transcripts(read).collect()] == [("T1", 15, "C1")]
