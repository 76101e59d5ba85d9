"""Pages and documents: visible text, links, tables, quotes, passages, near-identity, submissions."""

from __future__ import annotations

from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factloom.functions.text import host, quoted, squeeze


def visible_text(html: Column) -> Column:
    """Text of a page: scripts, styles, comments and tags out, entities of five kinds read, spaces single."""
    t = F.regexp_replace(F.coalesce(html, F.lit("")), r"(?is)<(script|style|noscript)[^>]*>.*?</(script|style|noscript)>", " ")
    t = F.regexp_replace(t, r"(?s)<!--.*?-->", " ")
    t = F.regexp_replace(t, r"<[^>]*>", " ")
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&nbsp;", " "), ("&amp;", "&")):
        t = F.replace(t, F.lit(entity), F.lit(char))
    return squeeze(t)


def links(pages: DataFrame, id_col: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(id, no, href, text) for every anchor, in order."""
    found = F.regexp_extract_all(F.col(html), F.lit(r'(?is)<a\s[^>]*?href="([^"]*)"[^>]*>.*?</a>'), F.lit(0))
    rows = pages.select(id_col, url, F.posexplode(found).alias("no", "a"))
    return rows.select(id_col, F.col("no").cast("long").alias("no"), F.regexp_extract("a", r'(?is)href="([^"]*)"', 1).alias("href"), visible_text(F.col("a")).alias("text"), host(F.col(url)).alias("page_host"))


def best_links(found: DataFrame, keywords: list[str], n: int, id_col: str = "page_id") -> DataFrame:
    """The n best links of a page: on the same host, by keyword hits in text or address, then in order."""
    own = (~F.col("href").rlike("^[a-z]+:")) | (host(F.col("href")) == F.col("page_host"))
    score = sum((F.lower(F.concat_ws(" ", "href", "text")).contains(k).cast("int") for k in keywords), F.lit(0))
    rows = found.where(own).withColumn("score", score)
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy(id_col).orderBy(F.desc("score"), "no"))).where(F.col("rank") <= n)


class _Tables(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.rows, self.row, self.cell = [], None, None

    def handle_starttag(self, tag, attrs):
        if tag == "tr":
            self.row = []
            self.rows.append(self.row)
        elif tag in ("td", "th") and self.row is not None:
            self.cell = []
            self.row.append(self.cell)

    def handle_endtag(self, tag):
        if tag in ("td", "th"):
            self.cell = None
        elif tag in ("tr", "table"):
            self.row = self.cell = None

    def handle_data(self, data):
        if self.cell is not None:
            self.cell.append(data)


def table_rows(html: str) -> list[list[str]]:
    parser = _Tables()
    parser.feed(html or "")
    return [[" ".join("".join(c).split()) for c in row] for row in parser.rows if row]


def html_tables(pages: DataFrame, id_col: str = "page_id", html: str = "html") -> DataFrame:
    """(id, row_no, cells) for every table row of a page."""

    def run(batches):
        for pdf in batches:
            out = [(i, n, cells) for i, h in zip(pdf[id_col], pdf[html], strict=True) for n, cells in enumerate(table_rows(h))]
            yield pd.DataFrame(out, columns=[id_col, "row_no", "cells"])

    return pages.select(id_col, html).mapInPandas(run, f"{id_col} {pages.schema[id_col].dataType.simpleString()}, row_no bigint, cells array<string>")


def quote_pairs(quotes: DataFrame, pages: DataFrame, quote: str, page: str, gram: int = 5) -> DataFrame:
    """Pairs of a quote and a page that holds it word for word, white space aside.

    Every page that holds a quote holds each of its inner runs of `gram` words. Only runs that some quote has are taken
    from the pages, without the pages' texts; the run that the fewest pages hold is the quote's join key, and the texts
    of the pages that hold it are checked as a whole. Quotes with fewer inner words meet pages by single words
    (short_quotes).
    """
    from factloom.operators.graph import keep

    q = quotes.withColumn("_q", squeeze(F.col(quote))).where("_q <> ''").withColumn("_w", F.split("_q", " "))

    def grams(w, enough):
        # Rows with too few words may come here before they are filtered.
        return F.when(enough, F.transform(F.sequence(F.lit(0), F.size(w) - gram), lambda i: F.xxhash64(F.array_join(F.slice(w, i + 1, gram), " "))))

    # The first and last word of a quote may be parts of words in the page.
    enough = F.size("_w") >= gram + 2
    long = q.where(enough).withColumn("_runs", F.array_distinct(grams(F.slice("_w", 2, F.greatest(F.size("_w") - 2, F.lit(0))), enough)))
    runs = keep(long.select(F.explode("_runs").alias("_key")).distinct(), "quote-runs")
    ids = [c for c in pages.columns if c != page]
    p = pages.withColumn("_p", squeeze(F.col(page))).withColumn("_pw", F.split("_p", " ")).withColumn("_h", F.xxhash64("_p"))
    held = p.where(F.size("_pw") >= gram).select(*ids, "_h", F.explode(F.array_distinct(grams(F.col("_pw"), F.size("_pw") >= gram))).alias("_key"))
    held = keep(held.join(runs, "_key", "left_semi").distinct(), "page-runs")
    rare = held.groupBy("_key").agg(F.count("*").alias("_n"))
    number = keep(long.withColumn("_no", F.monotonically_increasing_id()), "long-quotes")
    key = number.select("_no", F.explode("_runs").alias("_key")).join(rare, "_key").groupBy("_no").agg(F.min(F.struct("_n", "_key")).alias("_k"), F.count("*").alias("_found"))
    # A run that no page holds leaves a quote without pages.
    whole = number.join(key, "_no").where(F.col("_found") == F.size("_runs")).select(*quotes.columns, "_q", F.col("_k._key").alias("_key"))
    met = whole.join(held.select(*[F.col(c).alias(f"_i{n}") for n, c in enumerate(ids)], F.col("_h").alias("_ph"), "_key"), "_key").drop("_key")
    same = F.col("_h") == F.col("_ph")
    for n, c in enumerate(ids):
        same &= F.col(f"_x.{c}").eqNullSafe(F.col(f"_i{n}"))
    met = met.join(p.drop("_pw").alias("_x"), same).where(F.instr("_p", F.col("_q")) > 0)
    met = met.select(*quotes.columns, *[F.col(f"_x.{c}") for c in pages.columns])
    short = q.where(F.size("_w") < gram + 2)
    if short.isEmpty():
        return met
    return met.unionByName(short_quotes(short.select(*quotes.columns, "_q", "_w"), p.drop("_h")))


def short_quotes(q: DataFrame, p: DataFrame) -> DataFrame:
    """Pairs of a quote (_q, its words _w) of any length and a page (_p, its words _pw) that holds it.

    A page that holds a quote has a word that is the quote's longest inner word, or, where a quote has no more than
    two words, that holds the first of them at its end or the last at its start, or the only one anywhere. Such
    words are looked up among the distinct words of all pages, by the first letters of what they must hold, and
    pages are met by the words found; each pair that met is checked as a whole, once.
    """
    letters = 4
    first, last = F.element_at("_w", 1), F.element_at("_w", -1)
    at_end = F.char_length(first) >= F.char_length(last)
    longest = F.aggregate(F.slice("_w", 2, F.greatest(F.size("_w") - 2, F.lit(0))), F.lit(""), lambda a, x: F.when(F.char_length(x) > F.char_length(a), x).otherwise(a))
    need = q.select("_q", F.when(F.size("_w") > 2, longest).when(F.size("_w") == 1, first).when(at_end, first).otherwise(last).alias("_need"), F.when(F.size("_w") > 2, "is").when(F.size("_w") == 1, "in").when(at_end, "end").otherwise("start").alias("_how")).distinct()
    need = need.withColumn("_key", F.when(F.col("_how") == "is", F.concat(F.lit("="), "_need")).otherwise(F.left("_need", F.lit(letters))))
    p = p.withColumn("_page", F.xxhash64("_p"))  # equal hashes only meet: the whole text decides
    words = p.select("_page", F.explode(F.array_distinct("_pw")).alias("_word"))
    # Lookaheads find overlapping runs in one pass over a word, however long.
    held = F.array_distinct(F.concat(F.array(F.concat(F.lit("="), "_word")), *[F.regexp_extract_all("_word", F.lit(f"(?s)(?=(.{{{n}}}))"), F.lit(1)) for n in range(1, letters + 1)]))
    known = words.select("_word").distinct().withColumn("_key", F.explode(held))
    fits = F.when(F.col("_how") == "is", F.col("_word") == F.col("_need")).when(F.col("_how") == "end", F.endswith("_word", "_need")).when(F.col("_how") == "start", F.startswith("_word", "_need")).otherwise(F.contains("_word", "_need"))
    hits = known.join(need, "_key").where(fits).select("_q", "_word").distinct()
    pairs = words.join(hits, "_word").select("_q", "_page").distinct()
    return q.join(pairs, "_q").join(p, "_page").where(F.instr("_p", F.col("_q")) > 0).drop("_q", "_w", "_p", "_pw", "_page")


def passages(docs: DataFrame, size: int, step: int, words: list[str], text: str = "text") -> DataFrame:
    """(doc columns, start, passage, score): overlapping windows of characters scored by the words they hold."""
    starts = F.sequence(F.lit(0), F.greatest(F.char_length(text) - 1, F.lit(0)), F.lit(step))
    rows = docs.withColumn("start", F.explode(starts)).withColumn("passage", F.substring(F.col(text), F.col("start") + 1, F.lit(size)))
    score = sum((F.size(F.split(F.lower("passage"), w)) - 1 for w in words), F.lit(0))
    return rows.drop(text).withColumn("score", score.cast("long"))


def budget_pick(rows: DataFrame, group: str, cost: str, budget: int, order: list[str]) -> DataFrame:
    """Takes rows of a group in order, skipping any that would exceed the budget; the skip depends on what was taken."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(order, kind="stable")
        left, keep = budget, []
        for c in pdf[cost]:
            keep.append(c <= left)
            left -= c if keep[-1] else 0
        return pdf[keep]

    return rows.groupBy(group).applyInPandas(run, rows.schema)


def near_identical(docs: DataFrame, id_col: str, text: str, chars: int = 5000) -> DataFrame:
    """(id, first_id): documents whose first characters, white space collapsed, are the same, and the first of them."""
    sign = docs.select(id_col, F.sha2(F.left(squeeze(F.col(text)), F.lit(chars)), 256).alias("sign"))
    first = sign.groupBy("sign").agg(F.min(id_col).alias("first_id"))
    return sign.join(first, "sign").select(id_col, "first_id")


def contacts(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    """(id, kind, value): distinct phones and e-mail addresses of a text, in order of value."""
    phones = F.transform(F.regexp_extract_all(text, F.lit(r"\(?\d{3}\)?[ .-]\d{3}[ .-]\d{4}"), F.lit(0)), lambda x: F.struct(F.lit("phone").alias("kind"), F.regexp_replace(x, "[^0-9]", "").alias("value")))
    mails = F.transform(F.regexp_extract_all(text, F.lit(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"), F.lit(0)), lambda x: F.struct(F.lit("email").alias("kind"), F.lower(x).alias("value")))
    return docs.select(id_col, F.explode(F.array_distinct(F.concat(phones, mails))).alias("c")).select(id_col, "c.kind", "c.value")


SUBMISSION = "entity string, agent string, sources array<struct<source_ref: string, url: string, kind: string>>, assertions array<struct<field: string, value: string, source_ref: string, quote: string, confidence: double>>, verdict struct<status: string, reason: string>"


def submissions(rows: DataFrame, payload: str) -> DataFrame:
    """The payload column parsed by its schema; `problem` tells what keeps it from being read."""
    p = F.from_json(payload, SUBMISSION, {"mode": "PERMISSIVE"})
    out = rows.withColumn("p", p)
    problem = F.when(F.col("p").isNull() | F.col("p.entity").isNull(), "not a submission").when(F.coalesce(F.size("p.sources"), F.lit(0)) < 1, "no sources")
    return out.withColumn("problem", problem)


def cited_facts(rows: DataFrame, id_col: str, pages: DataFrame) -> DataFrame:
    """(id, entity, field, value, url, kind, basis, rejected): each assertion with its source and the first rule it fails.

    pages: (url, text). A quote must stand on the cited page and state the value.
    """
    a = rows.where("problem is null").select(id_col, "p.entity", "p.sources", F.explode("p.assertions").alias("a"))
    s = F.filter("sources", lambda s: s["source_ref"] == F.col("a.source_ref"))
    a = a.select(id_col, "entity", F.col("a.field").alias("field"), F.col("a.value").alias("value"), F.col("a.quote").alias("quote"), F.get(s, F.lit(0)).alias("s"))
    a = a.join(pages.select(F.col("url").alias("_u"), F.col("text").alias("_t")), F.col("s.url") == F.col("_u"), "left")
    states = F.instr(F.lower("quote"), F.lower("value")) > 0
    rejected = F.when(F.col("s").isNull(), "unknown source").when(F.col("_t").isNull(), "page not fetched").when(~quoted(F.col("quote"), F.col("_t")), "quote not on the page").when(~states, "quote does not state the value")
    basis = F.when(F.col("s.kind").isin("registry_page", "filing"), "web_verified").when(F.col("s.kind") == "company_site", "web_primary").otherwise("web_cited")
    return a.select(id_col, "entity", "field", "value", F.col("s.url").alias("url"), F.col("s.kind").alias("kind"), basis.alias("basis"), rejected.alias("rejected"))
