"""Line dedup: an exact set-similarity join of lines that removes every later match.

A line is the set of its distinct shingles of K words. Lines of equal sets are one class, which stands at its
first line. A line goes if an earlier line, by (doc_id, line number), reaches Jaccard LIKE with it; what is
earlier is judged on the input. Candidates come from rarity-ordered prefixes (sets.py): classes that share a
token pass the length filter, the positional filter, and a bitmap that bounds the tokens which one of the two
lacks (sets.families). What may match makes families; a family's lines meet once, and each class is checked on
whole sets against earlier ones, likeliest first, until one matches. Large families are parted by size and dealt
to chunks that meet in pairs. Equal lines of some megabytes of documents are settled there, before anything is shuffled.

Defined cases: lines of fewer than `least_words` words (and empty lines) always stay: LEAST_WORDS unless told,
none in the query, where shorter lines match as a whole; lines are parted by line feeds; null texts stay null;
rows that repeat both id and text are one document and fare alike; a null id comes first, and an id that is text
without a whole number counts as null; an empty table gives an empty result; other columns pass through, whatever
their names. A line longer than others takes its own size in memory, and some 30 times that for its tokens while
it is read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from factloom.llm import jaccard, sets
from factloom.llm.common import components, free, mapped, portions, save, slices, table, utf8
from factloom.llm.suffixes import keyed, text_key

K, LIKE, LEAST_WORDS = 5, 80, 5


def measured(docs: DataFrame, k: int, t: int, least_words: int) -> DataFrame:
    """Rows of kind 0: the first line (doc_id, key, line) of a class (cls, n, odd) in some megabytes of documents; of kind 2: its later lines there; of kind 1: (bucket, count) of the sketch as cls and n."""

    def run(batches):
        import pyarrow as pa

        from factloom.llm import sets

        counts = np.zeros(sets.SKETCH, np.int64)
        names = ["kind", "doc_id", "key", "line", "cls", "n", "odd"]
        for batch in (part for whole in batches for part in slices(whole, 2)):
            data, offsets = utf8(batch.column(2))
            held = []
            for i, j in portions(offsets):
                part, offs = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
                bounds, at = sets.line_offsets(part, offs)
                first, tokens = sets.unit_sets(part, bounds, k, None, least_words)
                counts += np.bincount((tokens & np.uint64(sets.SKETCH - 1)).astype(np.int64), minlength=sets.SKETCH)
                own = np.repeat(np.arange(j - i), np.diff(at))
                line, n = np.arange(len(own)) - at[:-1][own], np.diff(first)
                use = np.flatnonzero(n > 0)
                odd = np.array(sets.odd_bits(first, tokens, t), object)[use]
                held.append((i + own[use], line[use], sets.classes(first, tokens)[use], n[use], odd))
            if not held:
                continue
            row, line, cls, n, odd = (np.concatenate(x) for x in zip(*held, strict=True))
            # The rows in order of (doc_id, key), null first; rows that repeat both are one document.
            ids, keys = batch.column(0).fill_null(-(1 << 63)).to_numpy(), batch.column(1).to_numpy()
            null = batch.column(0).is_null().to_numpy(zero_copy_only=False)
            order = np.lexsort((keys, ids, ~null))
            new = np.ones(len(order), bool)
            new[1:] = (ids[order][1:] != ids[order][:-1]) | (keys[order][1:] != keys[order][:-1]) | (null[order][1:] != null[order][:-1])
            rank = np.empty(len(order), np.int64)
            rank[order] = np.cumsum(new)
            once = np.zeros(len(order), bool)
            once[order[new]] = True
            use = np.flatnonzero(once[row])
            use = use[np.lexsort((line[use], rank[row[use]], cls[use]))]
            lead = np.ones(len(use), bool)
            lead[1:] = cls[use][1:] != cls[use][:-1]
            take = pa.array(row[use])
            cols = [pa.array(np.where(lead, 0, 2).astype(np.int32)), batch.column(0).take(take), batch.column(1).take(take), pa.array(line[use].astype(np.int32)), pa.array(cls[use].view(np.int64)), pa.array(n[use])]
            cols.append(pa.array([x if y else None for x, y in zip(odd[use].tolist(), lead.tolist(), strict=True)], pa.binary()))
            yield pa.RecordBatch.from_arrays(cols, names)
        hit = np.flatnonzero(counts)
        nothing = pa.nulls(len(hit), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(np.ones(len(hit), np.int32)), nothing, nothing, pa.nulls(len(hit), pa.int32()), pa.array(hit), pa.array(counts[hit]), pa.nulls(len(hit), pa.binary())], names)

    rows = keyed(docs).select(sets.whole_number(docs, "doc_id").alias("doc_id"), "key", "text")
    return save(mapped(rows, run, "kind int, doc_id bigint, key bigint, line int, cls bigint, n bigint, odd binary"), "lines", "kind")


def later_in(first: np.ndarray, tokens: np.ndarray, place: list, t: int) -> set[int]:
    """Which of the sets tokens[first[i]:first[i + 1]] reach t with one of an earlier place."""
    order = np.zeros(len(place), np.int64)
    order[sorted(range(len(place)), key=place.__getitem__)] = np.arange(len(place))
    gone = np.zeros(len(place), bool)
    for x, y in jaccard.meetings(first, tokens, t, lambda a, b: ~gone[np.where(order[a] > order[b], a, b)]):
        late = x if order[x] > order[y] else y
        if not gone[late] and jaccard.reaches(tokens[first[x] : first[x + 1]], tokens[first[y] : first[y + 1]], t):
            gone[late] = True
    return set(np.flatnonzero(gone).tolist())


def later_matches(docs: DataFrame, k: int = K, t: int = LIKE, least_words: int = LEAST_WORDS) -> DataFrame:
    """(doc_id, key, lines): the numbers of the lines that go; key as keyed() gives it."""
    found = measured(docs, k, t, least_words)
    level, n = sets.read_levels(found.where("kind = 1").select(F.col("cls").alias("bucket"), "n"))
    # A document that stands in several rows has one place.
    by = Window.partitionBy("cls").orderBy("doc_id", "key", "line")
    ranked = save(found.where("kind = 0").drop("kind").withColumns({"turn": F.row_number().over(by), "place": F.rank().over(by)}), "line-classes")
    first = ranked.where("turn = 1")
    # Tokens of equal rank are ordered by their hash alone, so a token is the same whichever set it comes from.
    parts = sets.parts_of(n * (100 - t) // 100, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    packed = sets.prefixes(docs, k, t, level, least_words, parts)
    cells = sets.shared_cells(packed, "line-prefixes").join(first.select("cls", "n", "odd"), "cls")
    edges = save(sets.families(cells, t), "line-edges")
    nodes = edges.select(F.col("a").alias("node")).unionAll(edges.select("b")).distinct()
    family = components(edges, nodes).select(F.col("node").alias("cls"), F.col("component").alias("family"))
    family = save(family.join(first.drop("odd", "turn", "place"), "cls"), "line-families")
    # A row for every document of the text asked for: the lines are the same, one of each class goes on.
    units = sets.texts_of(docs, family.groupBy("doc_id", "key").agg(F.collect_list(F.struct("cls", "line")).alias("asked")))
    # A variable holds the lines, so that a text is split once; an outer generator gets no filter over its own input.
    asked = of_lines("text", lambda p: F.transform("asked", lambda x: F.struct(x["cls"].alias("cls"), F.get(p, x["line"]).alias("unit"))))
    units = save(units.select(F.inline_outer(asked)), "line-texts")
    groups = sets.dealt(family.select("cls", "family", F.col("n").alias("size")), t)
    groups = groups.join(units, "cls").join(family.select("cls", "doc_id", "key", "line"), "cls")

    def run(batches):
        import pyarrow as pa

        from factloom.llm import lines, sets

        for rows_ in sets.whole_rows(batches):
            first_, tokens = sets.sets_of([r[2].encode() for r in rows_], k)
            cuts = np.array([0, *(i for i in range(1, len(rows_)) if rows_[i][0] != rows_[i - 1][0]), len(rows_)])
            place = [(r[3] is not None, r[3] or 0, r[4], r[5]) for r in rows_]
            out = [rows_[x if place[x] > place[y] else y][1] for x, y in zip(*sets.small_pairs(first_, tokens, cuts, t), strict=True)]
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                if b - a > sets.SMALL:
                    out += [rows_[a + x][1] for x in lines.later_in(first_[a : b + 1] - first_[a], tokens[first_[a] : first_[b]], place[a:b], t)]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.int64())], ["cls"])

    dealt = groups.select("group", "cls", "unit", "doc_id", "key", "line").repartition("group").sortWithinPartitions("group", "cls")
    late = save(mapped(dealt, run, "cls bigint").distinct(), "line-matches")
    equal = found.where("kind = 2").unionByName(ranked.where("place > 1"), allowMissingColumns=True).select("doc_id", "key", "line")
    gone = equal.unionByName(first.join(late, "cls").select("doc_id", "key", "line"))
    return gone.groupBy("doc_id", "key").agg(F.collect_set("line").alias("lines"))


def of_lines(text: str, what):
    """what(lines) of a text, which is split once however often what looks at its lines."""
    return F.transform(F.array(F.split(F.coalesce(text, F.lit("")), "\n", -1)), what)[0]


def dedup(docs: DataFrame, k: int = K, t: int = LIKE, least_words: int = LEAST_WORDS, report: bool = False) -> DataFrame:
    """docs with the later matches cut from text; with report=True instead doc_id, n_lines, n_removed, kept_sha256."""
    gone = later_matches(docs, k, t, least_words)
    c_key, c_id, c_gone_key, c_gone = (free(docs, x) for x in ("_key", "_gone_id", "_gone_key", "_gone"))
    gone = gone.select(F.col("doc_id").alias(c_id), F.col("key").alias(c_gone_key), F.col("lines").alias(c_gone))
    rows = docs.withColumn(c_key, text_key(F.col("text")))
    joined = rows.join(gone.hint("shuffle_hash"), sets.whole_number(docs, "doc_id").eqNullSafe(F.col(c_id)) & (F.col(c_key) == F.col(c_gone_key)), "left")
    lines_of = F.split(F.coalesce("text", F.lit("")), "\n", -1)
    stays = of_lines("text", lambda p: F.array_join(F.transform(F.array_except(F.sequence(F.lit(0), F.size(p) - 1), c_gone), lambda i: F.get(p, i)), "\n"))
    kept = F.when(F.col(c_gone).isNull(), F.col("text")).otherwise(stays)
    if not report:
        return joined.select(*[kept.alias(c) if c.lower() == "text" else F.col(f"`{c}`") for c in docs.columns])
    return joined.select("doc_id", F.size(lines_of).cast("long").alias("n_lines"), F.when(F.col(c_gone).isNull(), 0).otherwise(F.size(c_gone)).cast("long").alias("n_removed"), F.sha2(F.coalesce(kept, F.lit("")), 256).alias("kept_sha256"))


def op10_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup(table(spark, sf_dir, "documents"), least_words=1, report=True)
