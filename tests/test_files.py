"""Record files read, diffed, written and read again: own small files of every shape that the input may have."""

import gzip

import pytest
from pyspark.sql import functions as F

from concord.operators import audit, diff, summary, unpack
from concord.sources import records
from concord.sources.store import Store

FORMAT = ["Allele", "Effect", "Feature", "Grade", "Notation"]


def text(rows, fields=FORMAT, contigs=("chr22",)):
    head = ["##fileformat=X", *(f"##contig=<ID={c}>" for c in contigs), '##tool="v1" build="37"', f'##INFO=<ID=CSQ,Number=.,Description="Format: {"|".join(fields)}">', "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO"]
    return "\n".join(head + [f"{c}\t{p}\t.\t{r}\t{a}\t.\t.\tCSQ={','.join(e)}" for c, p, r, a, e in rows]) + "\n"


def run(spark, folder, name, candidate, truth, fields=(FORMAT, FORMAT), contigs=(("chr22",), ("chr22",)), needs=None, contig=None):
    """Both sides from files to counts, as a user would."""
    sides, lists, ranks = [], [], None
    for side, rows, own, declared in zip(("candidate", "truth"), (candidate, truth), fields, contigs):
        path = folder / f"{name}_{side}.txt"
        path.write_text(text(rows, own, declared))
        lines = records.read_lines(spark, str(path))
        header = records.header_catalogue(lines)
        lists.append(records.field_list(header))
        found = records.require_positions(records.scan_records(lines)).where("not skipped").withColumn("run", F.lit("r"))
        sides.append(found)
        ranks = records.contig_ranks(header).drop("file") if side == "truth" or ranks is None else ranks
    shared, c_only, t_only = unpack.field_asymmetry(*lists)
    for found in sides:
        audit.require_ranked(found, ranks)
        audit.require_sorted(audit.order_violations(found, "file", "contig", "pos", "seq", ranks, Store(spark, "t")))
    if contig:
        sides = [s.where(F.col("contig").isin(contig, "chr" + contig)) for s in sides]
    rows, values = [], [f for f in shared if f not in ("Allele", "Feature")]
    for found, own in zip(sides, lists):
        key = (own.index("Allele"), own.index("Feature"))
        rest = [f for f in own if f not in ("Allele", "Feature")]
        rows.append(unpack.unpacked(found, len(own), key).withColumn("values", F.array(*[unpack.named_value(rest, f) for f in values])))
    joined = diff.align(*map(unpack.annotations, rows))
    counted = diff.tally(joined, values, {"r": []}, needs or {})
    counts = diff.join_rate(diff.tallied_coverage(counted)).first()
    by_field = diff.per_field(counted, diff.tallied_coverage(counted), values)
    overall = diff.overall(by_field).first()
    bad = [unpack.side_counts(r, "x").first() for r in rows]
    return {
        "counts": tuple(counts[c] for c in ("aligned", "only_candidate", "only_truth", "join_rate")) if counts else None,
        "overall": overall["overall_pct"] if overall else None,
        "malformed": [b["malformed_x"] if b else 0 for b in bad],
        "duplicates": [b["duplicate_x"] if b else 0 for b in bad],
        "fields": (shared, c_only, t_only),
        "by_field": by_field,
        "mismatches": diff.cell_mismatches(joined, values, {"r": []}, needs or {}),
    }


LEFT_ROWS = [("chr22", 100, "A", "G", ["G|missense|F1|low|c.1A>G"]), ("chr22", 200, "C", "T", ["T|intron|F2||c.9C>T"])]
RIGHT_ROWS = [("chr22", 100, "A", "G", ["G|missense|F1|high|"]), ("chr22", 200, "C", "T", ["T|intron|F2||"])]


def test_two_rows(spark, tmp_path):
    got = run(spark, tmp_path, "two_rows", LEFT_ROWS, RIGHT_ROWS, needs={"Notation": "notation"})
    assert got["counts"] == (2, 0, 0, 1.0)
    fields = {r["field"]: r for r in got["by_field"].collect()}
    assert fields["Grade"]["value_diff"] == 1 and fields["Notation"]["flag_expected"] == 2 and got["mismatches"].count() == 3
    for contig, expected in (("22", (2, 0, 0, 1.0)), ("1", None)):
        assert run(spark, tmp_path, "two_rows", LEFT_ROWS, RIGHT_ROWS, contig=contig)["counts"] == expected


def test_order_and_contigs_are_refused(spark, tmp_path):
    with pytest.raises(ValueError, match="22:100 came after 22:200"):
        run(spark, tmp_path, "unsorted", LEFT_ROWS[::-1], RIGHT_ROWS)
    odd = [("chrUn_A", 1, "A", "G", ["G|x|F1|a|"])]
    with pytest.raises(ValueError, match="Un_A"):
        run(spark, tmp_path, "unranked", odd, RIGHT_ROWS)
    with pytest.raises(ValueError, match="'M'"):
        run(spark, tmp_path, "mito", [("chrM", 1, "A", "G", ["G|x|F1|a|"])], [("MT", 1, "A", "G", ["G|x|F1|a|"])], contigs=(("chrM",), ("MT",)))


def test_one_sided_fields(spark, tmp_path):
    c, t = FORMAT[:4] + ["Left"], FORMAT[:4] + ["Right"]
    got = run(spark, tmp_path, "own_fields", RIGHT_ROWS, RIGHT_ROWS, fields=(c, t))
    assert got["fields"] == (FORMAT[:4], ["Left"], ["Right"]) and got["overall"] == 100.0


def test_short_entries(spark, tmp_path):
    good = ["G|a|F1|x|", "G|b|F2|y|"]
    got = run(spark, tmp_path, "cut", [("22", 1, "A", "G", [*good, "G|a"])], [("22", 1, "A", "G", ["G|b", *good[::-1]])])
    assert (got["malformed"], got["counts"][0], got["overall"], got["mismatches"].count()) == ([1, 1], 2, 100.0, 0)


ALLELES = ["T|a|F1|1|", "T|a|F2|2|", "GGTA|a|F1|3|", "GGTA|a|F2|4|"]


def test_alternatives_in_any_order(spark, tmp_path):
    got = run(spark, tmp_path, "pair", [("22", 1, "C", "T,GGTA", ALLELES)], [("22", 1, "C", "T,GGTA", ALLELES[::-1])])
    assert (got["counts"], got["mismatches"].count(), got["malformed"]) == ((4, 0, 0, 1.0), 0, [0, 0])
    changed = [*ALLELES[:3], "GGTA|a|F2|9|"]
    got = run(spark, tmp_path, "swapped", [("22", 1, "C", "GGTA,T", changed)], [("22", 1, "C", "T,GGTA", ALLELES)])
    (row,) = got["mismatches"].collect()
    assert got["counts"] == (4, 0, 0, 1.0) and (row["alt"], row["allele"], row["field"]) == ("GGTA,T", "GGTA", "Grade")


def test_one_side_has_more(spark, tmp_path):
    got = run(spark, tmp_path, "more", [("22", 1, "C", "T", ["T|a|F1|1|", "T|a|F2|1|"])], [("22", 1, "C", "T", ["T|a|F1|1|"])])
    assert got["counts"] == (1, 1, 0, 0.5) and got["overall"] == 100.0


def test_two_contigs_and_repeated_records(spark, tmp_path):
    c = [("1", 1, "A", "G", ["G|x|F1|a|", "G|x|F2|a|"]), ("1", 5, "A", "G", ["G|x|F1|a|"]), ("2", 1, "A", "G", ["G|x|F1|a|", "G|x|F9|b|"])]
    t = [("1", 1, "A", "G", ["G|x|F1|a|", "G|x|F2|b|"]), ("2", 1, "A", "G", ["G|x|F1|a|", "G|x|F9|b|", "G|x|F8|b|"]), ("2", 7, "A", "G", ["G|x|F8|b|"])]
    two = (("1", "2"), ("1", "2"))
    got = run(spark, tmp_path, "two", c, t, contigs=two)
    assert got["counts"] == (4, 1, 2, 0.5714)
    parts = [run(spark, tmp_path, "two", c, t, contigs=two, contig=x) for x in "12"]
    assert tuple(sum(p["counts"][i] for p in parts) for i in range(3)) == got["counts"][:3]
    again = [("22", 1, "C", "T", ["T|a|F1|1|", "T|a|F2|1|"]), ("22", 1, "C", "T", ["T|a|F1|9|"])]
    got = run(spark, tmp_path, "dup", again, again)
    assert (got["duplicates"], got["counts"][0], got["overall"]) == ([1, 1], 2, 100.0)


def test_headers(spark, tmp_path):
    (tmp_path / "h").mkdir()
    (tmp_path / "h" / "a.txt").write_text(text(LEFT_ROWS, contigs=("chr1", "chr2", "chr1", "chr3")) + "22\t7\tshort\n22\t8\t.\tA\tG\t.\t.\tDP=3\n")
    (tmp_path / "h" / "b.txt").write_text(text(LEFT_ROWS, fields=FORMAT[:3], contigs=("chr2",)))
    lines = records.read_lines(spark, str(tmp_path / "h"))
    header = records.header_catalogue(lines)
    name = lambda r: r["file"][-5]
    assert {name(r): r["fields"] for r in records.field_lists(header).collect()} == {"a": FORMAT, "b": FORMAT[:3]}
    with pytest.raises(ValueError, match="different fields"):
        records.field_list(header)
    assert records.field_list(header.limit(0)) == []
    # declared again after chr2, chr1 has as many contigs before it as chr3
    assert {(name(r), r["contig"]): r["rank"] for r in records.contig_ranks(header).collect()} == {("a", "1"): 2, ("a", "2"): 1, ("a", "3"): 2, ("b", "2"): 0}
    assert {(r["key"], r["value"]) for r in records.header_attributes(header.where("key = 'tool'")).collect()} == {("build", "37")}
    assert {name(r): r["value"] for r in records.header_value(header, "fileformat").collect()} == {"a": "X", "b": "X"}
    found = records.scan_records(lines.where(F.col("file").endswith("a.txt")))
    assert (found.count(), found.where("skipped").count()) == (4, 2)
    assert sorted(map(tuple, records.scan_positions(lines.where(F.col("file").endswith("a.txt"))).collect())) == [("22", 7), ("22", 8), ("22", 100), ("22", 200)]
    assert records.scan_keys(lines).where("pos = 100").count() == 1
    audit.assert_annotated(found.where("not skipped"), header)
    with pytest.raises(ValueError, match="declares no"):
        audit.assert_annotated(found, header.limit(0))
    with pytest.raises(ValueError, match="no annotated record"):
        audit.assert_annotated(found.limit(0), header)
    with pytest.raises(ValueError, match="position"):
        records.require_positions(found.withColumn("pos", F.lit(None).cast("long")))


def test_gzip_keeps_file_order(spark, tmp_path):
    """Members joined end to end, as block compression writes them; the first of two equal records wins."""
    body = [("22", 1, "A", "G", [f"G|x|F1|{i}|"]) for i in range(300)]
    whole = text(body).encode()
    with open(tmp_path / "x.txt.gz", "wb") as f:
        for at in range(0, len(whole), 2000):
            f.write(gzip.compress(whole[at : at + 2000]))
    lines = records.read_lines(spark, str(tmp_path / "x.txt.gz"))
    rows = records.scan_records(lines).withColumn("run", F.lit("r"))
    first = unpack.annotations(unpack.unpacked(rows, 5, (0, 2))).collect()
    assert lines.rdd.getNumPartitions() > 1 and rows.count() == 300 and [r["values"][1] for r in first] == ["0"]


def test_mismatch_files(spark, tmp_path):
    m = run(spark, tmp_path, "two_rows", LEFT_ROWS, RIGHT_ROWS)["mismatches"]
    records.write_mismatches(m.drop("run", "alts"), str(tmp_path / "t"), text=True)
    back = records.read_mismatches(spark, str(tmp_path / "t"))
    assert sorted(map(tuple, back.collect())) == sorted(tuple("" if v is None else str(v) for v in r) for r in m.drop("run", "alts").collect())
    (tmp_path / "crlf.tsv").write_bytes(b"field\tfeature\tcategory\r\nGrade\tNM_1\tvalue_diff\r\nGrade\t\ttruth_only\r\n")
    crlf = records.read_mismatches(spark, str(tmp_path / "crlf.tsv"))
    assert crlf.columns == ["field", "feature", "category"] and {tuple(r) for r in crlf.collect()} == {("Grade", "NM_1", "value_diff"), ("Grade", "", "truth_only")}
    assert {r["kind"] for r in summary.triage_counts(crlf).collect()} == {"REFSEQ", "NONE"}
    records.write_mismatches(m, str(tmp_path / "p"))
    assert spark.read.parquet(str(tmp_path / "p")).count() == 3


def test_tables(spark, tmp_path):
    (tmp_path / "r.tsv").write_text("chunk\tregion\tn_variants\n0\tchr1:5-9\t3\n1\tchr1:10-20\t4\n")
    rows = records.parse_regions(records.read_table(spark, str(tmp_path / "r.tsv"), "region string,chunk int,n_variants long")).collect()
    assert [(r["chunk"], r["contig"], r["start"], r["end"], r["n_variants"]) for r in rows] == [(0, "chr1", 5, 9, 3), (1, "chr1", 10, 20, 4)]
    with pytest.raises(ValueError, match="lacks"):
        records.read_table(spark, str(tmp_path / "r.tsv"), "region string,start int")
    (tmp_path / "empty.tsv").write_text("chunk\tregion\n")
    with pytest.raises(ValueError, match="empty"):
        records.read_table(spark, str(tmp_path / "empty.tsv"), "chunk int")
