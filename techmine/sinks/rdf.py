"""Graph serialisation: N-Triples (one line per triple) and Turtle (one block
per subject).  Both are produced by DataFrame expressions and written with
``write.text``; nothing passes through the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from techmine.operators.graph import PREFIXES, TRIPLE_COLS
from techmine.operators.joins import broadcast_if_small
from techmine.session import written


def escape_literal(c: Column) -> Column:
    """N-Triples string escaping: backslash first, then quote, LF, CR, TAB."""
    out = F.replace(c, F.lit("\\"), F.lit("\\\\"))
    for raw, esc in (('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        out = F.replace(out, F.lit(raw), F.lit(esc))
    return out


def _object_term(o: Column, kind: Column, datatype: Column) -> Column:
    lit_term = F.concat(F.lit('"'), escape_literal(o), F.lit('"'),
                        F.when(datatype.isNotNull(), F.concat(F.lit("^^<"), datatype, F.lit(">")))
                         .otherwise(F.lit("")))
    return F.when(kind == "iri", F.concat(F.lit("<"), o, F.lit(">"))).otherwise(lit_term)


def ntriples_lines(triples: DataFrame) -> DataFrame:
    """SNK6: one ``value`` line per triple: ``<s> <p> object .``"""
    t = triples.select(*TRIPLE_COLS)
    return t.select(F.concat(F.lit("<"), F.col("s"), F.lit("> <"), F.col("p"), F.lit("> "),
                             _object_term(F.col("o"), F.col("o_kind"), F.col("datatype")),
                             F.lit(" .")).alias("value"))


def write_ntriples(triples: DataFrame, path: str, compression: str = "none") -> None:
    """Lines as text files; ``read_ntriples`` tells the compression by their names."""
    ntriples_lines(triples).write.mode("overwrite").text(path, compression=compression)


def _short(c: Column) -> Column:
    """Prefixed name when the IRI starts with a bound namespace and the local
    part is a plain name; else ``<iri>``."""
    out = F.concat(F.lit("<"), c, F.lit(">"))
    for pfx, ns in PREFIXES.items():
        local = F.substring(c, len(ns) + 1, 1 << 30)
        ok = c.startswith(ns) & local.rlike(r"^[A-Za-z_][A-Za-z0-9_-]*\z")
        out = F.when(ok, F.concat(F.lit(pfx + ":"), local)).otherwise(out)
    return out


# Triples of one block; a subject with more is written as several blocks.
BLOCK_TRIPLES = 1000


def turtle_blocks(triples: DataFrame, block_triples: int = BLOCK_TRIPLES) -> DataFrame:
    """AG8 + SNK5: one Turtle block per subject, predicates sorted.

    Columns: s, block.  A subject with more than ``block_triples`` triples (a
    topic that is the parent of most others) is dealt by object over several
    blocks of about that size, which Turtle allows, so no list grows with the
    graph.
    """
    t = triples.select(*TRIPLE_COLS)
    hubs = (t.groupBy("s").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > block_triples)
             .select("s", F.ceil(F.col("n") / block_triples).cast("int").alias("parts")))
    hubs = written(hubs, "hubs")  # else the size check and the join would each count the graph
    t = t.join(broadcast_if_small(hubs), "s", "left").withColumn(
        "part", F.pmod(F.xxhash64("p", "o"), F.coalesce("parts", F.lit(1))))
    lit_obj = F.concat(F.lit('"'), escape_literal(F.col("o")), F.lit('"'),
                       F.when(F.col("datatype").isNotNull(),
                              F.concat(F.lit("^^"), _short(F.col("datatype")))).otherwise(F.lit("")))
    obj = F.when(F.col("o_kind") == "iri", _short(F.col("o"))).otherwise(lit_obj)
    pred = F.when(F.col("p") == PREFIXES["rdf"] + "type", F.lit("a")).otherwise(_short(F.col("p")))
    per = t.select("s", "part", F.struct(F.col("p").alias("k1"), F.col("o").alias("k2"),
                                 F.concat(pred, F.lit(" "), obj).alias("po")).alias("x"))
    return (per.groupBy("s", "part")
               .agg(F.sort_array(F.collect_list("x")).alias("xs"))
               .select("s", F.concat(_short(F.col("s")), F.lit(" "),
                                     F.array_join(F.transform("xs", lambda x: x["po"]), " ;\n    "),
                                     F.lit(" .")).alias("block")))


def turtle_text(triples: DataFrame, files: int | None = None) -> DataFrame:
    """Turtle documents, one per output file, each starting with the prefix lines.

    Blocks are spread over ``files`` keys by subject hash; every key gets a
    header row sorted in front of its blocks, so every written part file
    declares its prefixes before using them (a part that receives two keys
    simply repeats the same declarations, which Turtle allows).
    """
    spark = triples.sparkSession
    if files is None:  # one document per shuffle partition, sized by the cluster's setting
        files = int(spark.conf.get("spark.sql.shuffle.partitions"))
    header = "\n".join(f"@prefix {p}: <{ns}> ." for p, ns in PREFIXES.items()) + "\n"
    blocks = (turtle_blocks(triples)
              .select(F.pmod(F.xxhash64("s"), F.lit(files)).alias("k"), F.lit(1).alias("ord"),
                      F.col("s"), F.col("block").alias("value")))
    heads = spark.range(files).select(F.col("id").alias("k"), F.lit(0).alias("ord"),
                                      F.lit("").alias("s"), F.lit(header).alias("value"))
    return (heads.unionByName(blocks)
                 .repartition(files, "k")
                 .sortWithinPartitions("k", "ord", "s")
                 .select("value"))


def write_turtle(triples: DataFrame, path: str, files: int | None = None) -> None:
    turtle_text(triples, files).write.mode("overwrite").text(path)
