"""Block-compressed text, headers, published tables, delimited mismatches, outputs in storage, settings."""

import gzip
import io
import os
import random

import pytest
from pyspark.sql import functions as F

from concord.operators import ranges
from concord.sources import blocks, records, store


def block_file(text, size):
    return b"".join(blocks.packed(text[i : i + size]) for i in range(0, len(text), size)) + blocks.END


@pytest.mark.parametrize("size", [7, 100, 1000, 0xFF00])
@pytest.mark.parametrize("end", [b"\n", b""])
def test_ranges_of_blocks_give_each_line_once(size, end):
    """Short and empty lines, lines over many blocks and ranges, ranges without a block, a last line without an end."""
    rng = random.Random(size)
    for long in (0, 1):
        lines = [("x" * rng.choice([0, 1, 5, 50, 700 * long]) + str(i)).encode() for i in range(300)]
        raw = block_file(b"\n".join(lines) + end, size)
        assert gzip.decompress(raw) == b"\n".join(lines) + end
        for split in (150, 200, 5000, 1 << 26):
            got = [x for b in range(0, len(raw), split) for x in blocks.lines_between(io.BytesIO(raw), b, min(b + split, len(raw)), len(raw))]
            assert [x[2] for x in got] == lines and got == sorted(got, key=lambda x: x[:2])


def test_block_files_are_read_by_many_tasks(spark, tmp_path):
    rng = random.Random(3)
    lines = ["".join(rng.choices("abcdefgh\tXYZ", k=rng.randrange(0, 900))) + str(i) for i in range(9000)]
    raw = block_file(("\n".join(lines) + "\n").encode(), 60_000)
    assert raw.count(blocks.MAGIC + b"\0\0\0\0\0\xff\6\0BC") >= 64
    (tmp_path / "x.gz").write_bytes(raw)
    plain = records.read_lines(spark, str(tmp_path / "x.gz")).orderBy("seq").collect()
    rows = blocks.read_blocks(spark, str(tmp_path / "x.gz"), split=100_000)
    assert rows.rdd.getNumPartitions() > 8 and rows.select(F.spark_partition_id()).distinct().count() > 8
    got = rows.orderBy("file", "seq").collect()
    assert [r["value"] for r in got] == [r["value"] for r in plain] == lines


def test_blocks_written_and_read_again(spark, tmp_path):
    lines = spark.range(5000).select(F.concat(F.lit("é"), F.repeat(F.lit("y"), (F.col("id") % 90).cast("int")), F.col("id").cast("string")).alias("value"))
    blocks.write_blocks(lines.repartition(3), str(tmp_path / "b"), 4000)
    assert len([f for f in os.listdir(tmp_path / "b") if f.startswith("part")]) == 3
    back = blocks.read_blocks(spark, str(tmp_path / "b"), split=5000).select("value")
    assert back.exceptAll(lines).isEmpty() and back.count() == 5000
    assert spark.read.text(str(tmp_path / "b")).count() == 5000
    with pytest.raises(ValueError):
        blocks.write_blocks(lines, str(tmp_path / "c"), 70_000)
    (tmp_path / "other.gz").write_bytes(gzip.compress(b"a\nb\n"))
    with pytest.raises(Exception, match="no block at byte 0"):
        blocks.read_blocks(spark, str(tmp_path / "other.gz")).collect()


def test_files_of_any_kind_together(spark, tmp_path):
    texts = {"a.txt": ["a1", "", "a2"], "b.gz": ["b1", "b2"], "c.gz": [f"c{i}" for i in range(900)], "d.txt": []}
    for name, lines in texts.items():
        raw = "".join(x + "\n" for x in lines).encode()
        (tmp_path / name).write_bytes(block_file(raw, 500) if name == "c.gz" else gzip.compress(raw) if name == "b.gz" else raw)
    got = blocks.read_text(spark, str(tmp_path), split=300).orderBy("file", "seq").collect()
    for name, lines in texts.items():
        assert [r["value"] for r in got if r["file"].endswith(name)] == lines
    assert len({r["seq"]["block"] for r in got if r["file"].endswith("c.gz")}) > 5
    assert blocks.read_text(spark, str(tmp_path / "d.txt")).count() == 0 and blocks.read_text(spark, [str(tmp_path / "c.gz")]).count() == 900


class Counted(io.BytesIO):
    taken = 0

    def read(self, n=-1):
        out = super().read(n)
        self.taken += len(out)
        return out


@pytest.mark.parametrize("pack", [bytes, gzip.compress, lambda t: block_file(t, 0xFF00)])
def test_headers_end_where_records_begin(pack):
    head = [f"##contig=<ID={i}>" for i in range(500)]
    for rows in (10, 200_000):
        text = "\n".join([*head, "#CHROM\tPOS", *(f"1\t{i}" for i in range(rows)), "##late=1", ""]).encode()
        source = Counted(pack(text))
        assert list(blocks.header_lines(source)) == head and source.taken <= 1 << 16
    assert list(blocks.header_lines(io.BytesIO(pack(b"##a=1\r\n##b")))) == ["##a=1", "##b"]
    assert list(blocks.header_lines(io.BytesIO(b""))) == list(blocks.header_lines(io.BytesIO(pack(b"#")))) == []


def test_read_headers(spark, tmp_path):
    (tmp_path / "a.vcf").write_text("##k=1\n##k=2\n#CHROM\n1\t2\n##k=3\n")
    (tmp_path / "b.vcf.gz").write_bytes(gzip.compress(b"##k=9\n1\t2\n"))
    (tmp_path / "c.vcf").write_text("")
    found = records.header_catalogue(blocks.read_headers(spark, str(tmp_path)))
    assert sorted(r["value"] for r in found.collect()) == ["1", "2", "9"]
    assert {r["value"] for r in records.header_value(found, "k").collect()} == {"1", "9"}


def test_publish(spark, tmp_path):
    """A reader during a swap keeps its table, a writer that dies before the pointer changes nothing."""
    path = "file://" + str(tmp_path / "t")
    with pytest.raises(FileNotFoundError):
        store.read_published(spark, path)
    store.publish(spark.range(5), path)
    before = store.read_published(spark, path)
    spark.range(9).write.parquet(f"{path}/v-dead")
    assert store.read_published(spark, path).count() == 5
    store.publish(spark.range(7), path)
    assert (before.count(), store.read_published(spark, path).count()) == (5, 7)
    assert len(store.prune(spark, path)) == 2 and store.prune(spark, path) == [] and store.read_published(spark, path).count() == 7
    assert not [f for f in os.listdir(tmp_path / "t") if f.startswith("_current.")]


def test_an_empty_table_leaves_the_published_one(spark, tmp_path):
    path, rows = str(tmp_path / "c"), spark.createDataFrame([("1", 5), ("2", 6)], "contig string, pos long")
    records.write_by_contig(rows, path)
    with pytest.raises(ValueError, match="nothing to write"):
        records.write_by_contig(rows.limit(0), path)
    assert records.by_contig(spark, path).count() == 2


def test_slices_read_one_contig_and_few_row_groups(spark, tmp_path):
    rows = spark.range(20000).select((F.col("id") % 4).cast("string").alias("contig"), F.col("id").alias("pos"))
    path = str(tmp_path / "c")
    records.write_by_contig(rows, path)
    got = ranges.slice_region(records.by_contig(spark, path), "chr2", 100, 400)
    plan = got._jdf.queryExecution().explainString(got._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    line = lambda name: next(x for x in plan.splitlines() if x.startswith(name))
    assert "contig" in line("PartitionFilters") and "GreaterThanOrEqual(pos,100)" in line("PushedFilters")
    assert sorted(r["pos"] for r in got.collect()) == list(range(102, 401, 4))
    assert all("contig=2" in f for f in got.select("_metadata.file_path").distinct().toPandas()["file_path"])


@pytest.mark.parametrize("odd", ['"abc', 'd"e', '"', '""', "a\tb", "a\nb", "a\r\nb", "\\", 'x\\"y', " lead", "trail ", "#", "", None, "é'"])
def test_mismatches_as_text_come_back(spark, tmp_path, odd):
    rows = [("1", odd, "plain", odd), ("2", "x", odd, "y")]
    df = spark.createDataFrame(rows, "contig string, candidate_val string, truth_val string, category string")
    records.write_mismatches(df, str(tmp_path / "m"), text=True)
    back = records.read_mismatches(spark, str(tmp_path / "m"))
    assert back.columns == df.columns
    assert sorted(map(tuple, back.collect())) == sorted(tuple("" if v is None else v for v in r) for r in rows)


def test_observed_outputs(spark, tmp_path):
    for name, text in (("run=a/contig=1/x.txt", "1"), ("run=a/contig=2/x.txt", ""), ("other/x.txt", "1")):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text(text)
    found = records.observed_outputs(spark, str(tmp_path), "(run=[^/]+/contig=[^/]+)/")
    assert [tuple(r) for r in found.collect()] == [("run=a/contig=1", 1)]
    assert "content" not in found._jdf.queryExecution().executedPlan().toString().split("FileScan")[1].split("ReadSchema")[1]


def test_settings_cells(spark):
    cells = lambda *x: spark.createDataFrame([(f"r{i}", c) for i, c in enumerate(x)], "run string, settings string")
    found = records.read_settings(cells('{"a": true, "b": "x, y", "c": {"d": [1]}}', " {} ", '{"a": null}'))
    assert sorted(map(tuple, found.collect()), key=str) == [("r0", "a", "true"), ("r0", "b", "x, y"), ("r0", "c", '{"d":[1]}'), ("r2", "a", None)]
    for bad, what in ((None, "r1 has an empty cell"), ("  ", "empty"), ("{", "r1 has a malformed cell"), ("[1]", "malformed"), ("3", "malformed"), ("null", "malformed")):
        with pytest.raises(ValueError, match=what):
            records.read_settings(cells("{}", bad))
