"""License scan: TF-IDF cosine of lines to notice templates, then folder inheritance.

Terms are the runs of ``a-z0-9`` after lower-casing ``A``-``Z``.  A term's weight
is its count times ``ln((1 + N) / (1 + df)) + 1`` with N and df counted over all
files; a term outside the templates counts as never seen.  Every line of a file
is compared to every template, and for licence files the whole text too; a file's
own license is the template of greatest cosine, if that reaches the threshold
(ties: the first template, then the first line; the whole text is line -1, no license line -2).

Only lines that can reach the threshold are weighed.  A template's terms of
greatest weight are its anchors, taken until the rest alone stays under the
threshold; by the Cauchy-Schwarz inequality a line without any anchor cannot
match, so the filter loses nothing.

A file without a license of its own takes that of the nearest folder above it
that has one.  A folder's license comes from its licence files (by name), else
from files whose first or last line is a notice; of several the smallest path decides.
Folders are joined by path, once per distinct folder, not per file.

Null and empty texts have no license of their own and can inherit.  Files with a
null path are scanned and inherit nothing.  Repeated rows are judged alike and
all come back.  With no files the result is empty.  Only ``doc_id``, ``path`` and
``text`` of the input are read.  DataFrame functions only.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Short license notices, one row per accepted wording.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "you may not use this file except in compliance with the License"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MPL-2.0", "subject to the terms of the Mozilla Public License, v. 2.0."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "Released into the public domain under CC0 1.0."),
    ("all-rights-reserved", "All rights reserved."),
)
LICENSE_NAMES = r"(?i)^(licen[sc]e|copying|notice|copyright)([._-].*)?$"

THRESHOLD = 0.7
DIGITS = 9
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def terms_of(text: str) -> list[str]:
    return re.findall(r"[a-z0-9]+", text.translate(str.maketrans(UPPER, LOWER)))


def _lowered(col):
    return F.translate(col, UPPER, LOWER)


def _terms(col):
    return F.filter(F.split(_lowered(col), "[^a-z0-9]+"), lambda t: t != "")


def _values(spark, rows: list[tuple], columns: str) -> DataFrame:
    """A small literal table."""
    def lit(v):
        return "'" + v.replace("'", "''") + "'" if isinstance(v, str) else f"{v!r}D" if isinstance(v, float) else str(v)
    return spark.sql("SELECT * FROM VALUES " + ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
                     + f" AS t({columns})")


class Weights:
    """Template vectors under the corpus's document frequencies."""

    def __init__(self, templates, n_files: int, df: dict[str, int]):
        self.idf = {t: math.log((1 + n_files) / (1 + df.get(t, 0))) + 1 for _, text in templates for t in terms_of(text)}
        self.unseen = math.log(1 + n_files) + 1
        self.vectors = [{t: n * self.idf[t] for t, n in Counter(terms_of(text)).items()} for _, text in templates]
        self.norms = [math.sqrt(sum(w * w for w in v.values())) for v in self.vectors]

    def anchors(self, threshold: float) -> list[str]:
        out = set()
        for vector, norm in zip(self.vectors, self.norms):
            rest = norm * norm
            for term in sorted(vector, key=lambda t: (-vector[t], t)):
                if math.sqrt(max(rest, 0)) < threshold * norm * (1 - 1e-9):
                    break
                out.add(term)
                rest -= vector[term] ** 2
        return sorted(out)


def corpus_frequencies(files: DataFrame, vocabulary: list[str]) -> tuple[int, dict[str, int]]:
    """Number of files, and of files holding each template term (as many rows as the templates have terms)."""
    known = F.array(*[F.lit(t) for t in vocabulary])
    found = F.array_intersect(_terms(files["text"]), known)
    counts = files.select(F.explode(F.concat(F.coalesce(found, F.array().cast("array<string>")), F.array(F.lit("")))).alias("t")).groupBy(
        "t").count().collect()
    table = {r["t"]: r["count"] for r in counts}
    return table.pop("", 0), table


def scan_licenses(files: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, path, own_license, cosine, line_no, inherited_license, license_dir, license of every row."""
    spark = files.sparkSession
    files = files.select(files["doc_id"], files["path"], files["text"])
    vocabulary = sorted({t for _, text in templates for t in terms_of(text)})
    weights = Weights(templates, *corpus_frequencies(files, vocabulary))
    anchors = weights.anchors(threshold)
    any_anchor = "(^|[^a-z0-9])(" + "|".join(anchors) + ")($|[^a-z0-9])"
    rows = files.withColumn("_h", F.xxhash64("text")).withColumn(
        "_dir", F.when(F.col("path").contains("/"), F.expr("substring(path, 1, length(path) - length(substring_index(path, '/', -1)) - 1)"))
        .when(F.col("path").isNotNull(), F.lit(""))).withColumn("_named", F.coalesce(
            F.substring_index("path", "/", -1).rlike(LICENSE_NAMES), F.lit(False)))
    # segments that hold an anchor
    able = rows.filter(_lowered(F.col("text")).rlike(any_anchor)).select("path", "_h", "_dir", "_named", "text").dropDuplicates(["path", "_h"])
    lines = able.withColumn("_lines", F.split("text", "\n")).select(
        "path", "_h", F.posexplode("_lines").alias("line_no", "segment"), F.size("_lines").alias("n_lines")).select(
        "path", "_h", "line_no", "segment", F.col("line_no").isin(0, F.col("n_lines") - 1).alias("edge"))
    whole = able.filter("_named").select("path", "_h", F.lit(-1).alias("line_no"), F.col("text").alias("segment"),
                                         F.lit(False).alias("edge"))
    segments = lines.unionByName(whole).filter(_lowered(F.col("segment")).rlike(any_anchor))
    key = ["path", "_h", "line_no", "edge"]
    terms = (segments.select(*key, F.explode(_terms(F.col("segment"))).alias("term"))
             .groupBy(*key, "term").agg(F.count(F.lit(1)).alias("tf")))
    idf = _values(spark, [(t, w) for t, w in sorted(weights.idf.items())], "term, idf")
    weighed = terms.join(F.broadcast(idf), "term", "left").withColumn(
        "w", F.col("tf") * F.coalesce("idf", F.lit(weights.unseen)))
    vectors = _values(spark, [(t, i, w / norm) for i, (v, norm) in enumerate(zip(weights.vectors, weights.norms))
                              for t, w in sorted(v.items())], "term, template, tw")
    norms = weighed.groupBy(*key).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    dots = weighed.join(F.broadcast(vectors), "term").groupBy(*key, "template").agg(F.sum(F.col("w") * F.col("tw")).alias("dot"))
    same = F.col("l.path").eqNullSafe(F.col("r.path")) & (F.col("l._h") == F.col("r._h")) & (F.col("l.line_no") == F.col("r.line_no"))
    scored = (dots.alias("l").join(norms.alias("r"), same)
              .select("l.path", "l._h", "l.line_no", "l.edge", "l.template", F.round(F.col("dot") / F.col("norm"), DIGITS).alias("cosine"))
              .filter(F.col("cosine") >= threshold))
    best = scored.groupBy("path", "_h").agg(
        F.max(F.struct("cosine", (-F.col("template")).alias("t"), (-F.col("line_no")).alias("l"))).alias("b"),
        F.max("edge").alias("opens"))
    names = _values(spark, [(i, name) for i, (name, _) in enumerate(templates)], "template, own_license")
    best = (best.select("path", "_h", "opens", F.col("b.cosine").alias("cosine"), (-F.col("b.l")).alias("line_no"),
                        (-F.col("b.t")).alias("template")).join(F.broadcast(names), "template").drop("template"))
    # folders
    speaks = (able.select("path", "_h", "_dir", "_named").filter(F.col("path").isNotNull()).join(best, ["path", "_h"])
              .filter(F.col("_named") | F.col("opens")))
    folder = speaks.groupBy("_dir").agg(
        F.min(F.struct((~F.col("_named")).alias("n"), "path", "own_license")).alias("f")).select(
        F.col("_dir").alias("license_dir"), F.col("f.own_license").alias("inherited_license"))
    dirs = rows.select("_dir").filter(F.col("_dir").isNotNull()).distinct()
    parts = F.split("_dir", "/")
    above = dirs.select("_dir", F.explode(F.concat(F.array(F.lit("")), F.transform(
        F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/")))).alias("license_dir")).distinct()
    nearest = (above.join(folder, "license_dir").groupBy("_dir").agg(
        F.max_by(F.struct("license_dir", "inherited_license"), F.length("license_dir")).alias("f"))
        .select("_dir", "f.license_dir", "f.inherited_license"))
    own = best.select(F.col("path").alias("_p"), F.col("_h").alias("_bh"), "cosine", "line_no", "own_license")
    out = rows.drop("text").join(own, F.col("path").eqNullSafe(F.col("_p")) & (F.col("_h") == F.col("_bh")), "left").join(nearest, "_dir", "left")
    return out.select("doc_id", "path", "own_license", "cosine", F.coalesce("line_no", F.lit(-2)).alias("line_no"),
                      "inherited_license", "license_dir", F.coalesce("own_license", "inherited_license").alias("license"))


def document_paths(docs: DataFrame) -> DataFrame:
    """``documents`` as a file tree: source / id div 4096 / id div 64 / id.txt.

    The table has no paths, so the tree is derived from source and id; every
    4096th id lies in the source's folder and every 64th one level up.
    """
    ident = docs["doc_id"].cast("long")
    source, name = F.coalesce(docs["source"], F.lit("unknown")), F.concat(F.coalesce(ident.cast("string"), F.lit("null")), F.lit(".txt"))
    upper, lower = F.floor(ident / 4096).cast("string"), F.floor(ident / 64).cast("string")
    path = (F.when(F.coalesce(ident % 4096, F.lit(0)) == 0, F.concat_ws("/", source, name))
            .when(ident % 64 == 0, F.concat_ws("/", source, upper, name))
            .otherwise(F.concat_ws("/", source, upper, lower, name)))
    return docs.select(ident.alias("doc_id"), path.alias("path"), docs["text"])


def _sql() -> str:
    templates = ", ".join(f"({i}, '{n}', '{t}')" for i, (n, t) in enumerate(TEMPLATES))
    lowered = f"translate({{}}, '{UPPER}', '{LOWER}')"
    words = "regexp_extract_all(" + lowered + ", '[a-z0-9]+')"
    return f"""
WITH files AS (
  SELECT doc_id, text, CASE WHEN coalesce(doc_id % 4096, 0) = 0 THEN concat_ws('/', s, n)
    WHEN doc_id % 64 = 0 THEN concat_ws('/', s, (doc_id // 4096)::VARCHAR, n)
    ELSE concat_ws('/', s, (doc_id // 4096)::VARCHAR, (doc_id // 64)::VARCHAR, n) END AS path
  FROM (SELECT *, coalesce(source, 'unknown') AS s, coalesce(doc_id::VARCHAR, 'null') || '.txt' AS n FROM documents)),
rows AS (SELECT *, regexp_replace(path, '/[^/]*$', '') AS dir FROM files),
templates(template, name, wording) AS (VALUES {templates}),
vocabulary AS (SELECT template, term, count(*) AS tf FROM (
  SELECT template, unnest({words.format('wording')}) AS term FROM templates) GROUP BY ALL),
total AS (SELECT count(*) AS n FROM files),
df AS (SELECT term, count(*) AS df FROM (SELECT DISTINCT path, unnest({words.format('text')}) AS term FROM files)
       WHERE term IN (SELECT term FROM vocabulary) GROUP BY term),
idf AS (SELECT DISTINCT term, ln((1 + n) / (1 + coalesce(df, 0))) + 1 AS idf FROM vocabulary LEFT JOIN df USING (term), total),
tvec AS (SELECT template, term, tf * idf AS w FROM vocabulary JOIN idf USING (term)),
tnorm AS (SELECT template, sqrt(sum(w * w)) AS tn FROM tvec GROUP BY template),
lines AS (SELECT path, generate_subscripts(l, 1) - 1 AS line_no, unnest(l) AS line
          FROM (SELECT path, string_split(text, chr(10)) AS l FROM files)),
terms AS (SELECT path, line_no, term, count(*) AS tf FROM (
  SELECT path, line_no, unnest({words.format('line')}) AS term FROM lines) GROUP BY ALL),
weighed AS (SELECT path, line_no, term, tf * coalesce(idf, ln(1 + n) + 1) AS w FROM terms LEFT JOIN idf USING (term), total),
norms AS (SELECT path, line_no, sqrt(sum(w * w)) AS norm FROM weighed GROUP BY ALL),
scored AS (SELECT path, line_no, template, round(sum(weighed.w * tvec.w) / any_value(tn) / any_value(norm), {DIGITS}) AS cosine
  FROM weighed JOIN tvec USING (term) JOIN tnorm USING (template) JOIN norms USING (path, line_no)
  GROUP BY path, line_no, template HAVING cosine >= {THRESHOLD}),
best AS (SELECT path, cosine, line_no, name AS own_license FROM scored JOIN templates USING (template)
  QUALIFY row_number() OVER (PARTITION BY path ORDER BY cosine DESC, template, line_no) = 1),
edges AS (SELECT path, len(string_split(text, chr(10))) - 1 AS last FROM files),
opens AS (SELECT DISTINCT path FROM scored JOIN edges USING (path) WHERE line_no IN (0, last)),
folder AS (SELECT dir, arg_min(own_license, path) AS inherited FROM rows JOIN best USING (path) SEMI JOIN opens USING (path) GROUP BY dir),
nearest AS (SELECT d.dir, arg_max(folder.dir, length(folder.dir)) AS license_dir, arg_max(inherited, length(folder.dir)) AS inherited_license
  FROM (SELECT DISTINCT dir FROM rows) d JOIN folder ON d.dir = folder.dir OR starts_with(d.dir, folder.dir || '/') GROUP BY d.dir)
SELECT doc_id, path, own_license, cosine, coalesce(line_no, -2)::INTEGER AS line_no, inherited_license, license_dir,
  coalesce(own_license, inherited_license) AS license
FROM rows LEFT JOIN best USING (path) LEFT JOIN nearest USING (dir)"""


ORACLE_SQL = _sql()
