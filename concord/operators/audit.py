"""Gates and audits: key sets, order, positions, plans, manifests, settings, replicates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from concord.functions.cells import natural_order, norm_contig
from concord.sources.store import SMALL_ROWS, Store

from .order import numbered, with_previous


def compare_keys(left: DataFrame, right: DataFrame, cols: list[str], store: Store | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(counts, only_left, only_right) of two key sets. Both sides are one tagged table, summed by key in each task before
    one shuffle; a store keeps its result, from which all three are then read. Null keys are keys."""
    side = lambda df, bit: df.select(*cols, F.lit(bit).alias("__side"))
    keys = side(left, 1).unionAll(side(right, 2)).groupBy(*cols).agg(F.bit_or("__side").alias("__sides"))
    keys = store.put(keys) if store else keys
    n = lambda *of: F.count_if(F.col("__sides").isin(*of))
    counts = keys.agg(n(1, 3).alias("n_left"), n(2, 3).alias("n_right"), n(3).alias("n_both"), n(1).alias("only_left"), n(2).alias("only_right"))
    only = lambda bit: keys.where(F.col("__sides") == bit).drop("__sides")
    return counts.withColumn("identical", (F.col("only_left") == 0) & (F.col("only_right") == 0)), only(1), only(2)


def examples(df: DataFrame, n: int = 10) -> DataFrame:
    return df.orderBy(*df.columns).limit(n)


def unranked_contigs(df: DataFrame, ranks: DataFrame) -> DataFrame:
    return df.select(norm_contig(F.col("contig")).alias("contig")).distinct().join(ranks, "contig", "left_anti")


def require_ranked(df: DataFrame, ranks: DataFrame) -> DataFrame:
    """df, if every contig of it has a rank; there is no default one."""
    lacking = [r["contig"] for r in unranked_contigs(df, ranks).orderBy("contig").limit(20).collect()]
    if lacking:
        raise ValueError(f"contigs that no header declares: {lacking}")
    return df


def order_violations(df: DataFrame, source: str, contig: str, pos: str, seq: str, ranks: DataFrame, store: Store) -> DataFrame:
    """(source, kind, contig, pos, previous_contig, previous_pos, seq) of rows that don't come after the row before them in
    their source, by rank of the contig, contig and position. kind: position, contig (one of a smaller rank, or one that
    had come already), unranked. Rows of one position in a row are in order."""
    rows = df.select(F.col(source).alias("source"), norm_contig(F.col(contig)).alias("contig"), F.col(pos).alias("pos"), F.col(seq).alias("seq"))
    rows = rows.join(ranks.select("contig", "rank"), "contig", "left")
    rows = with_previous(rows, ["source", "seq"], ["source", "rank", "contig", "pos"], "p", store)
    same = F.col("p.source") == F.col("source")
    back = F.struct("rank", "contig") < F.struct("p.rank", "p.contig")
    kind = F.when(F.col("rank").isNull(), "unranked").when(same & back, "contig").when(same & (F.col("p.contig") == F.col("contig")) & (F.col("pos") < F.col("p.pos")), "position")
    return rows.withColumn("kind", kind).where("kind is not null").select("source", "kind", "contig", "pos", F.when(same, F.col("p.contig")).alias("previous_contig"), F.when(same, F.col("p.pos")).alias("previous_pos"), "seq")


def require_sorted(violations: DataFrame) -> None:
    """Raises on the first violation, by source and both places."""
    rows = violations.orderBy("source", "seq").limit(1).collect()
    for r in rows:
        raise ValueError(f"{r['source']} is not in order ({r['kind']}): {r['contig']}:{r['pos']} came after {r['previous_contig']}:{r['previous_pos']}")


def require_equal_lines(left: DataFrame, right: DataFrame) -> None:
    """Raises unless each contig has as many lines in both bodies: else comparing them by position means nothing."""
    n = lambda df, name: df.groupBy("contig").agg(F.count(F.lit(1)).alias(name))
    a, b = n(left, "a"), n(right, "b")
    rows = a.join(b, a.contig.eqNullSafe(b.contig), "full_outer").select(F.coalesce(a.contig, b.contig).alias("contig"), F.coalesce("a", F.lit(0)).alias("a"), F.coalesce("b", F.lit(0)).alias("b"))
    bad = rows.where("a <> b").orderBy("contig").limit(5).collect()
    if bad:
        raise ValueError("bodies of different lengths can't be compared by position: " + "; ".join(f"{r['contig']}: {r['a']} and {r['b']} lines" for r in bad))


def positional_residual(left: DataFrame, right: DataFrame, strip: str, store: Store, require_equal: bool = True) -> DataFrame:
    """Of two bodies (contig, seq, line) compared line by line: lines, those that differ, those that still do without what
    strip matches, and the first three of these. Row numbers run within a contig (null is one), over range partitions.
    Bodies of different lengths are refused first, unless that isn't required."""
    if require_equal:
        require_equal_lines(left, right)
    number = lambda df, x: numbered(df.select("contig", "seq", "line"), ["contig"], ["seq", "line"], "rn", store).select(F.col("contig").alias(f"c{x}"), F.col("rn").alias(f"n{x}"), F.col("line").alias(x), F.lit(True).alias(f"in_{x}"))
    rows = number(left, "a").join(number(right, "b"), F.col("ca").eqNullSafe(F.col("cb")) & (F.col("na") == F.col("nb")), "full_outer")
    rows = rows.select(F.when(F.col("in_a"), F.col("ca")).otherwise(F.col("cb")).alias("contig"), F.coalesce("na", "nb").alias("rn"), "a", "b", "in_a", "in_b")
    bare = lambda c: F.regexp_replace(c, strip, "")
    alone = F.col("in_a").isNull() | F.col("in_b").isNull()
    differs = alone | ~F.col("a").eqNullSafe(F.col("b"))
    rests = differs & (alone | ~bare("a").eqNullSafe(bare("b")))
    rows = rows.select("contig", "rn", differs.alias("d"), rests.alias("r"))
    firsts = lambda acc, k: F.slice(F.array_sort(acc), 1, k)
    few = rows.where("r").groupBy("contig", F.floor(F.col("rn") / 10_000).alias("__at")).agg(firsts(F.collect_list("rn"), 3).alias("f")).groupBy(F.col("contig").alias("__c")).agg(firsts(F.flatten(F.collect_list("f")), 3).alias("first"))
    counts = rows.groupBy("contig").agg(F.count(F.lit(1)).alias("lines"), F.count_if("d").alias("raw"), F.count_if("r").alias("residual"))
    return counts.join(few, counts.contig.eqNullSafe(few["__c"]), "left").drop("__c")


def id_column(table: DataFrame, candidates: list[str]) -> str:
    found = next((c for c in candidates if c in table.columns), None)
    if found is None:
        raise ValueError(f"none of {candidates} in {table.schema.simpleString()}")
    return found


def id_membership(ids: DataFrame, table: DataFrame, candidates: list[str], literals: int = 1000) -> DataFrame:
    """(id, present) for each id; the table's id column is the first of the candidates that it has. The table loses all
    other rows before anything is shuffled: few ids become literals that the scan itself filters by, more are a semi join,
    broadcast up to SMALL_ROWS."""
    found = id_column(table, candidates)
    wanted = ids.select("id").distinct()
    some = wanted.limit(SMALL_ROWS + 1)
    n = some.count()
    if n <= literals:
        have = table.where(F.col(found).isin([r["id"] for r in some.collect()]))
    else:
        keys = wanted.select(F.col("id").alias(found))
        have = table.join(F.broadcast(keys) if n <= SMALL_ROWS else keys, found, "left_semi")
    have = have.select(F.col(found).alias("id")).distinct().withColumn("present", F.lit(True))
    return wanted.join(have, "id", "left").select("id", F.coalesce("present", F.lit(False)).alias("present"))


def plan_vs_observed(plan: DataFrame, outputs: DataFrame, timings: DataFrame, factor: float = 1.25) -> DataFrame:
    """(key, state, overran): missing, annotated (an output without a timing) or done."""
    rows = plan.join(outputs.select("key").distinct().withColumn("__out", F.lit(True)), "key", "left").join(timings, "key", "left")
    state = F.when(F.col("__out").isNull(), "missing").when(F.col("actual").isNull(), "annotated").otherwise("done")
    over = (state == "done") & (F.col("actual") > F.col("est") * factor)
    return rows.select("key", state.alias("state"), F.coalesce(over, F.lit(False)).alias("overran"))


def plan_summary(rows: DataFrame) -> DataFrame:
    return rows.groupBy("state").agg(F.count(F.lit(1)).alias("n"), F.count_if("overran").alias("overran"))


def reconcile_manifest(manifest: DataFrame, listing: DataFrame, allow: list[str] = ()) -> DataFrame:
    """(name, status): malformed (the manifest's digest is none), missing in the listing, differs (any other digest there,
    none included), extra (in the listing only, unless allowed)."""
    a, b = manifest.select("name", F.coalesce("digest", F.lit("")).alias("a")), listing.select("name", F.coalesce("digest", F.lit("")).alias("b"))
    good = F.col("a").rlike("^[0-9a-f]{32}$")
    extra = F.when(~F.col("name").isin(*allow), "extra") if allow else F.lit("extra")
    status = F.when(F.col("a").isNull(), extra).when(~good, "malformed").when(F.col("b").isNull(), "missing").when(F.col("a") != F.col("b"), "differs")
    return a.join(b, "name", "full_outer").select("name", status.alias("status")).where("status is not null")


def pairwise_runs(df: DataFrame, tag: str, key: list[str], values: list[str], tags: list[str]) -> DataFrame:
    """(a, b, differing) for each pair of runs: one pass, a column per run."""
    row = F.xxhash64(*values)
    wide = df.groupBy(*key).agg(*[F.max(F.when(F.col(tag) == t, row)).alias(t) for t in tags])
    pairs = [(a, b) for i, a in enumerate(tags) for b in tags[i + 1 :]]
    sums = wide.agg(*[F.count_if(~F.col(a).eqNullSafe(F.col(b))).alias(f"{a}|{b}") for a, b in pairs])
    return sums.select(F.inline(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"{a}|{b}").alias("differing")) for a, b in pairs])))


def audit_settings(settings: DataFrame, allowed: DataFrame) -> DataFrame:
    """(run, flag, verdict) of settings (run, flag) against an allow-list (flag, kind): the kind, or unknown, an error."""
    return settings.select("run", "flag").join(allowed, "flag", "left").select("run", "flag", F.coalesce("kind", F.lit("unknown")).alias("verdict"))


def audit_flavours(settings: DataFrame, allowed: DataFrame, declared: DataFrame, default: str) -> DataFrame:
    """(run, declared, resolved, verdict): the flavour that a run's settings select, default where they select none,
    against the one declared (run, flavour). verdict: ok, differs, or both where they select two."""
    chosen = settings.join(allowed.where("kind = 'flavour'").select("flag"), "flag", "left_semi").groupBy("run").agg(F.array_sort(F.collect_set("flag")).alias("flags"))
    rows = declared.select("run", F.col("flavour").alias("declared")).join(chosen, "run", "left")
    n = F.coalesce(F.size("flags"), F.lit(0))
    resolved = F.when(n < 2, F.coalesce(F.get("flags", F.lit(0)), F.lit(default)))
    verdict = F.when(n > 1, "both").when(resolved == F.col("declared"), "ok").otherwise("differs")
    return rows.select("run", "declared", resolved.alias("resolved"), verdict.alias("verdict"))


def require_settings(settings: DataFrame, allowed: DataFrame, declared: DataFrame, default: str) -> None:
    """Raises on unknown flags and on flavours other than declared."""
    bad = audit_settings(settings, allowed).where("verdict = 'unknown'").select("run", F.concat(F.lit("unknown "), "flag").alias("what"))
    bad = bad.union(audit_flavours(settings, allowed, declared, default).where("verdict <> 'ok'").select("run", F.concat_ws(" ", "verdict", "declared", "resolved")))
    rows = bad.distinct().orderBy("run", "what").limit(20).collect()
    if rows:
        raise ValueError("settings: " + "; ".join(f"{r['run']}: {r['what']}" for r in rows))


def integrity_counts(left: DataFrame, right: DataFrame, plan: DataFrame, by: list[str]) -> DataFrame:
    n = lambda df, name: df.groupBy(*by).agg(F.count(F.lit(1)).alias(name))
    return plan.join(n(left, "n_left"), by, "left").join(n(right, "n_right"), by, "left").fillna(0, ["n_left", "n_right"])


def pending(plan: DataFrame, done: DataFrame, by: list[str]) -> DataFrame:
    return plan.join(done, by, "left_anti")


def union_checked(parts: dict[str, DataFrame]) -> DataFrame:
    """Parts under their names, in one table."""
    out = None
    for name, df in parts.items():
        part = df.withColumn("part", F.lit(name))
        out = part if out is None else out.unionByName(part)
    return out


def concat_planned(plan: DataFrame, shards: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows in order, integrity) of shards put together as a plan (contig, chunk) lists them: contigs in natural order,
    chunks as numbers, rows of a shard by their seq. shards: (contig, chunk, seq, ...). Rows of shards that aren't planned
    stay out; a plan without shards is refused. integrity: (contig, chunk, n, state), state being ok, missing (a planned
    shard without rows), repeated (planned twice) or unplanned."""
    if plan.isEmpty():
        raise ValueError("the plan lists no shard")
    at = ["contig", "chunk"]
    planned = plan.groupBy(*at).agg(F.count(F.lit(1)).alias("planned"))
    have = shards.groupBy(*at).agg(F.count(F.lit(1)).alias("n"))
    state = F.when(F.col("planned").isNull(), "unplanned").when(F.col("planned") > 1, "repeated").when(F.col("n").isNull(), "missing").otherwise("ok")
    integrity = planned.join(have, at, "full_outer").select(*at, F.coalesce("n", F.lit(0)).alias("n"), state.alias("state"))
    keys = [*natural_order(F.col("contig")), "chunk", "seq"]
    rows = shards.join(planned.select(*at), at, "left_semi").repartitionByRange(*keys).sortWithinPartitions(*keys)
    return rows, integrity


def require_planned(integrity: DataFrame) -> None:
    """Raises on planned shards that are missing or repeated."""
    bad = integrity.where("state in ('missing', 'repeated')").orderBy("contig", "chunk").limit(20).collect()
    if bad:
        raise ValueError("; ".join(f"{r['contig']}, chunk {r['chunk']}: {r['state']}" for r in bad))


def union_integrity(whole: DataFrame, counts: DataFrame) -> DataFrame:
    """(part, n, expected, ok)."""
    got = whole.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    return counts.join(got, "part", "full_outer").select("part", F.coalesce("n", F.lit(0)).alias("n"), "expected", F.coalesce(F.col("n") == F.col("expected"), F.lit(False)).alias("ok"))


def split_count_gate(df: DataFrame, alt: str = "alt") -> DataFrame:
    """Records, and how many there must be once alternatives are split."""
    n = F.size(F.split(alt, ","))
    return df.agg(F.count(F.lit(1)).alias("records"), F.sum(n - 1).alias("extra"), F.sum(n).alias("expected"))


def assert_annotated(records: DataFrame, header: DataFrame, key: str = "CSQ") -> DataFrame:
    """The records, if the header declares the annotation and there is one."""
    if header.where(F.col("value").startswith(f"<ID={key},")).isEmpty():
        raise ValueError(f"the header declares no {key}")
    if records.isEmpty():
        raise ValueError("no annotated record")
    return records


def require_union(integrity: DataFrame) -> None:
    """Raises unless every part has as many rows as it must."""
    rows = integrity.where("not ok").limit(20).collect()
    if rows:
        raise ValueError("; ".join(f"{r['part']}: {r['n']} rows, not {r['expected']}" for r in rows))
