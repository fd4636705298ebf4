"""The splittable quoted scan against ``csv.reader``."""

import csv
import random

import pytest
from pyspark.sql import functions as F

from quern.sources import quoted, readers


def expected(path, sep="\t"):
    csv.field_size_limit(2**31 - 1)
    with open(path, encoding="utf-8") as f:
        return [r for r in csv.reader(f, delimiter=sep) if r]


def in_order(rows):
    return [r.fields for r in sorted(rows, key=lambda r: (r._file, r._block, r._row))]


@pytest.fixture
def small_blocks(spark):
    """Blocks of a few bytes, as if the files were huge."""
    held = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}

    def set_bytes(n):
        spark.conf.set("spark.sql.files.maxPartitionBytes", n)
        spark.conf.set("spark.sql.files.openCostInBytes", 1)
    yield set_bytes
    for k, v in held.items():
        spark.conf.set(k, v)


def random_file(rng, n):
    """Records with quotes, separators, breaks and stray quotes in all places."""
    bits = ["a", "bc", '"', '""', "\n", "\t", " ", "é", "x" * 30, '"q"', "\n\n", '5" disk', "\r\n"]
    out = []
    for _ in range(n):
        fields = []
        for _ in range(rng.randint(1, 4)):
            text = "".join(rng.choices(bits, k=rng.randint(0, 6)))
            kind = rng.random()
            if kind < 0.5:
                fields.append('"' + text.replace('"', '""') + '"' + ("" if kind < 0.45 else "tail\"s"))
            else:
                fields.append(text.replace("\n", "").replace("\t", "").replace("\r", "").lstrip('"'))
        out.append("\t".join(fields))
    return "\n".join(out) + rng.choice(["", "\n"])


@pytest.mark.parametrize("bytes_per_block", [40, 300, 1 << 20])
def test_equals_csv_reader(spark, tmp_path, small_blocks, bytes_per_block):
    small_blocks(bytes_per_block)
    rng = random.Random(bytes_per_block)
    paths = []
    for i in range(3):
        path = tmp_path / f"part{i}.tsv"
        path.write_bytes(random_file(rng, 120).encode())
        paths.append(str(path))
    table = quoted.scan_quoted(spark, paths)
    rows = table.collect()
    assert in_order(rows) == [r for p in paths for r in expected(p)]
    blocks = {(r._file, r._block) for r in rows}
    assert len(blocks) > (20 if bytes_per_block < 1000 else 3)


def test_record_over_many_blocks(spark, tmp_path, small_blocks):
    small_blocks(64)
    path = tmp_path / "long.tsv"
    path.write_text('1\t"' + "line without quotes\n" * 200 + 'end"\n2\tplain\n3\t"open ""and"" closed"\n')
    rows = quoted.scan_quoted(spark, str(path)).collect()
    assert in_order(rows) == expected(path) and len(rows) == 3


def test_unclosed_quote_ends_with_the_file(spark, tmp_path, small_blocks):
    small_blocks(30)
    path = tmp_path / "open.tsv"
    path.write_text('1\ta\n2\t"never closed\nmore and more\nand more')
    assert in_order(quoted.scan_quoted(spark, str(path)).collect()) == expected(path)
    for content in ("", "\n\n", "one\n"):
        path = tmp_path / f"f{len(content)}.tsv"
        path.write_text(content)
        assert in_order(quoted.scan_quoted(spark, str(path)).collect()) == expected(path)


def test_other_separator_and_compressed(spark, tmp_path):
    import gzip
    text = '1,"a\nb",c\n\n2,"d, ""e"""\n'
    (tmp_path / "f.csv").write_text(text)
    with gzip.open(tmp_path / "f.csv.gz", "wt") as f:
        f.write(text)
    rows = quoted.scan_quoted(spark, [str(tmp_path / "f.csv"), str(tmp_path / "f.csv.gz")], sep=",").collect()
    assert in_order(rows) == [["1", "a\nb", "c"], ["2", 'd, "e"']] * 2


def test_changed_splits_are_an_error(spark, tmp_path, small_blocks):
    small_blocks(100)
    path = tmp_path / "f.tsv"
    path.write_text('1\t"a\nb"\n' * 200)
    table = quoted.scan_quoted(spark, str(path))
    small_blocks(70)
    with pytest.raises(Exception, match="splits changed"):
        table.collect()


def test_readers_split_one_file(spark, tmp_path, small_blocks):
    small_blocks(200)
    folder = tmp_path / "video"
    folder.mkdir()
    path = folder / "corpus.tsv"
    path.write_text("".join(f'{i}\t"passage {i}\nwith a break"\textra\n' if i % 3 else f"{i}\n" for i in range(100)))
    read = readers.read_passages(spark, str(path), with_order=True)
    assert read.rdd.getNumPartitions() > 4
    assert [(r.pid, r.passage) for r in sorted(read.collect(), key=lambda r: (r._block, r._row))] == [
        (r[0], r[1]) for r in expected(path) if len(r) >= 2]
    assert read.where(F.col("domain") != "video").count() == 0
    path.write_text("".join(f'{i % 7}\t"query {i}\nand more"\n' for i in range(100)))
    assert dict(readers.read_queries(spark, str(path)).collect()) == {r[0]: r[1] for r in expected(path)}
