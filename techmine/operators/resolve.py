"""RES1: resolve each work to usable text by following fetched responses.

Inputs (landed tables, no network):
  works        (work_id, url, doi)
  responses    (url, status, content_type, body_text, page_texts)
  oa_location  (doi, url_for_pdf)            open-access lookup
  head_probe   (url, status, content_type)   publisher PDF probe

Every response is analysed once (native for PDFs, one Arrow HTML pass for
pages) into an outcome: text found, a link to follow, or fall back.  Works
then advance as a shrinking frontier: each round joins the frontier with the
outcome of its URL (no texts); a work leaves the frontier when it has text, or
when its next URL is missing or was already tried (a repeated URL ends the
search, so once the open-access lookup has answered, the publisher probe is
never reached).  URLs are finite and no work tries one twice, so the rounds end
by themselves.  Each round is checkpointed to the shared folder.  The texts are
joined once, at the end, by final URL.  Both sides of every join are shuffled,
so that adaptive execution can split a URL or doi that many works share; works
without a doi do not meet in one task.

Rules per URL:
  pdf  (content type contains application/pdf): page texts joined by blank
       lines and trimmed; blank -> fall back
  html (contains text/html): soft-404 phrase in the visible text -> fall back;
       viewer-text elements -> their text; else the first ``.pdf`` link if not
       tried yet; else fall back
  anything else, or no response -> fall back
  fall back = open-access pdf url, else the probed publisher url (HEAD 200 and
       content type contains pdf); an empty doi has no fall back
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from techmine.functions import text as TX
from techmine.functions.html import extract_html, first_pdf_link
from techmine.session import shared_dir

# Fixed value: publisher PDF address prefix probed for a doi.
PUBLISHER_PDF_PREFIX = "https://dl.acm.org/doi/pdf/"


def analyse_responses(responses: DataFrame, soft_phrases=TX.SOFT_ERROR_PHRASES) -> DataFrame:
    """(url, found_text, next_url) per distinct response URL.

    Each response is analysed where it lies (narrow); only the analysis,
    far smaller than the raw bodies, is deduplicated by URL."""
    r = responses
    ctype = F.lower(F.coalesce(F.col("content_type"), F.lit("")))
    pdf = (r.where(ctype.contains("application/pdf"))
            .select("url", TX.strip_ws(F.array_join(F.coalesce("page_texts", F.array().cast("array<string>")),
                                                    "\n\n")).alias("t"))
            .select("url", F.when(F.col("t") != "", F.col("t")).alias("found_text"),
                    F.lit(None).cast("string").alias("next_url")))
    html_rows = r.where(~ctype.contains("application/pdf") & ctype.contains("text/html"))
    parsed = extract_html(html_rows.select("url", F.col("body_text").alias("html")), "html", ["url"])
    soft = TX.soft_error(F.lower(F.col("visible_text")), soft_phrases)
    html = parsed.select(
        "url",
        F.when(~soft & F.col("viewer_text").isNotNull(), F.col("viewer_text")).alias("found_text"),
        F.when(~soft & F.col("viewer_text").isNull(), first_pdf_link("links", "url")).alias("next_url"))
    # Of several responses for a URL one with text wins, then one with a link,
    # then the smallest.
    pick = F.min(F.struct(F.col("found_text").isNull().alias("a"), F.col("next_url").isNull().alias("b"),
                          "found_text", "next_url")).alias("m")
    return pdf.unionByName(html).groupBy("url").agg(pick).select("url", "m.found_text", "m.next_url")


def fallback_urls(oa_location: DataFrame, head_probe: DataFrame, dois: DataFrame) -> DataFrame:
    """JN4 + SRC5 + SRC6: (doi, fallback_url) = open-access url, else probed publisher url."""
    d = dois.where(F.col("doi").isNotNull() & (F.col("doi") != "")).select("doi").distinct()
    oa = (oa_location.where(F.col("url_for_pdf").isNotNull() & (F.col("url_for_pdf") != ""))
                     .groupBy("doi").agg(F.min("url_for_pdf").alias("oa_url")))
    probe = (head_probe.where((F.col("status") == 200)
                              & F.lower(F.coalesce("content_type", F.lit(""))).contains("pdf"))
                       .select(F.col("url").alias("probe_url")).distinct())
    cand = d.withColumn("probe_url", F.concat(F.lit(PUBLISHER_PDF_PREFIX), F.col("doi")))
    cand = cand.join(probe, "probe_url", "left_semi").select("doi", "probe_url")
    return (d.join(oa, "doi", "left").join(cand, "doi", "left")
             .select("doi", F.coalesce("oa_url", "probe_url").alias("fallback_url")))


def resolve_text(works: DataFrame, responses: DataFrame, oa_location: DataFrame,
                 head_probe: DataFrame) -> DataFrame:
    """(work_id, text, final_url, hops); text and final_url null when nothing usable."""
    spark = works.sparkSession
    path = f"{shared_dir(spark, 'analysed')}/t"
    analysed_rows = analyse_responses(responses)
    analysed_rows.write.parquet(path)
    analysed = spark.read.schema(analysed_rows.schema).parquet(path)
    outcome = analysed.select("url", F.col("found_text").isNotNull().alias("found"), "next_url")
    fb = fallback_urls(oa_location, head_probe, works).checkpoint(eager=True)
    nothing = F.lit(None).cast("string")
    frontier = (works.where(F.col("url").isNotNull() & (F.col("url") != ""))
                     .select("work_id", "doi", "url", F.array("url").alias("tried"), F.lit(1).alias("hops")))
    done = [works.where(F.col("url").isNull() | (F.col("url") == "")).select(
        "work_id", nothing.alias("final_url"), F.lit(0).alias("hops"))]
    while True:
        # Works without a doi get a key of their own, so they don't meet in one task.
        key = F.when(F.col("doi").isNotNull() & (F.col("doi") != ""), F.col("doi")).otherwise(
            F.concat(F.lit("\0"), F.col("work_id").cast("string")))
        step = (frontier.join(outcome, "url", "left").withColumn("__key", key)
                        .join(fb.withColumnRenamed("doi", "__key"), "__key", "left").drop("__key"))
        # Checkpointed per hop: the next hop reads this one's rows only.
        step = (step.withColumn("follow", F.when(F.col("next_url").isNotNull()
                                                 & ~F.array_contains("tried", F.col("next_url")), F.col("next_url")))
                    .withColumn("nxt", F.coalesce("follow", "fallback_url"))
                    .withColumn("open", ~F.coalesce("found", F.lit(False)) & F.col("nxt").isNotNull()
                                & ~F.coalesce(F.array_contains("tried", F.col("nxt")), F.lit(False)))
                    .checkpoint(eager=True))
        done.append(step.where(~F.col("open")).select(
            "work_id", F.when(F.col("found"), F.col("url")).alias("final_url"), "hops"))
        frontier = step.where("open").select(
            "work_id", "doi", F.col("nxt").alias("url"), F.concat("tried", F.array("nxt")).alias("tried"),
            (F.col("hops") + 1).alias("hops"))
        if frontier.isEmpty():
            break
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    texts = analysed.where(F.col("found_text").isNotNull()).select(F.col("url").alias("final_url"),
                                                                   F.col("found_text").alias("text"))
    some = out.where(F.col("final_url").isNotNull()).join(texts, "final_url")
    none = out.where(F.col("final_url").isNull()).withColumn("text", nothing)
    return some.unionByName(none).select("work_id", "text", "final_url", "hops")
