import gzip

import pytest

from residua.operators.split import write_sequences_csv
from residua.sources import read_fasta, read_sequences_csv
from residua.sources.fasta import files_without_header

RECORDS = [
    ("P1 first protein n=4 Tax=Virus", "MAFSAEDVLKEYDRRRRMEALLLSLYYPNDRK"),
    ("P2 no body", ""),
    ("P3 arrow -> inside > header", "ACDEFGHIK" * 30),
    ("", "GG"),
    ("P5, with \"quotes\" and, commas", "W"),
]


def text_of(records, end="\n", width=10, final=True):
    lines = []
    for name, body in records:
        lines.append(">" + name)
        lines += [body[i : i + width] for i in range(0, len(body), width)]
    return end.join(lines) + (end if final else "")


def read(spark, path, **options):
    return sorted((r.sequence_id, r.sequence) for r in read_fasta(spark, str(path), **options).collect())


@pytest.mark.parametrize("end", ["\n", "\r\n"])
@pytest.mark.parametrize("final", [True, False])
def test_line_ends(spark, tmp_path, end, final):
    path = tmp_path / "a.fasta"
    path.write_text(text_of(RECORDS, end, final=final), newline="")
    assert read(spark, path) == sorted(RECORDS)


def test_gzip(spark, tmp_path):
    path = tmp_path / "a.fasta.gz"
    path.write_bytes(gzip.compress(text_of(RECORDS).encode()))
    assert read(spark, path) == sorted(RECORDS)
    assert read(spark, path, partitions=3) == sorted(RECORDS)


def test_blank_lines(spark, tmp_path):
    path = tmp_path / "a.fasta"
    path.write_text("\n\n>P1\nAC\n\nGT\n\n\n>P2\n\n")
    assert read(spark, path) == [("P1", "ACGT"), ("P2", "")]


@pytest.mark.parametrize("split_bytes", ["37", "100", "1000"])
def test_any_file_split_gives_the_same_records(spark, tmp_path, conf, split_bytes):
    records = [(f"P{i} > n={i}", "ACDEFGHIKL" * (i % 7)) for i in range(60)]
    path = tmp_path / "a.fasta"
    path.write_text(text_of(records))
    conf("spark.sql.files.maxPartitionBytes", split_bytes)
    conf("spark.sql.files.openCostInBytes", "0")
    rows = read_fasta(spark, str(path))
    assert rows.rdd.getNumPartitions() > 1
    assert read(spark, path) == sorted(records)


def test_directory_of_files(spark, tmp_path):
    for i, record in enumerate(RECORDS):
        (tmp_path / f"{i}.fasta").write_text(text_of([record]))
    assert read(spark, tmp_path) == sorted(RECORDS)


def test_odd_headers(spark, tmp_path):
    (tmp_path / "a.fasta").write_text(">\n>b\nAC\n>\n>c\nGG\n>>d\nT\n>\n")
    (tmp_path / "b.fasta").write_text("\n\r\n>>e\nAC\n>\n")
    (tmp_path / "c.fasta").write_text("")
    assert read(spark, tmp_path) == sorted(
        [("", ""), ("b", "AC"), ("", ""), ("c", "GG"), (">d", "T"), ("", ""), (">e", "AC"), ("", "")])


def test_text_before_the_first_header(spark, tmp_path):
    path = tmp_path / "a.fasta"
    path.write_text("junk\nmore\n>a\nAC\n")
    with pytest.raises(Exception, match="before the first header"):
        read(spark, path)
    assert read(spark, path, lead_in="drop") == [("a", "AC")]


def test_lone_carriage_returns(spark, tmp_path):
    path = tmp_path / "a.fasta"
    path.write_bytes(b">a\rAC\r>b\rGT\r")
    with pytest.raises(Exception, match="carriage return"):
        read(spark, path)


def test_lead_in_is_found(spark, tmp_path):
    (tmp_path / "good.fasta").write_text(">P1\nAC\n>P2\nGT\n")
    (tmp_path / "bad.fasta").write_text("; comment\n>P1\nAC\n")
    found = [r.file_path for r in files_without_header(spark, str(tmp_path)).collect()]
    assert len(found) == 1 and found[0].endswith("bad.fasta")


def test_csv_round_trip(spark, tmp_path):
    (tmp_path / "a.fasta").write_text(text_of(RECORDS))
    out = str(tmp_path / "csv")
    write_sequences_csv(read_fasta(spark, str(tmp_path / "a.fasta")), out)
    rows = read_sequences_csv(spark, out)
    assert sorted((r.sequence_id, r.sequence) for r in rows.collect()) == sorted(RECORDS)
    blanks = spark.createDataFrame([(" A ", " id x "), ("", "")], "sequence string, sequence_id string")
    write_sequences_csv(blanks, out + "2")
    assert sorted(map(tuple, read_sequences_csv(spark, out + "2").collect())) == [("", ""), (" A ", " id x ")]
    raw = read_sequences_csv(spark, out, null_as_empty=False)
    assert raw.where("sequence is null").count() == 1
    with pytest.raises(Exception, match="already exists"):
        write_sequences_csv(raw, out)
