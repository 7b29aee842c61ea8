"""Operator 3, license scans, with DataFrame functions only.

Evidence of a file, by sentences: every sentence is compared with notice templates by the cosine of TF-IDF vectors, both
within its line and with the lines of its paragraph joined (comment marks stripped). Document frequencies are counted
over all files. A vector can only reach the threshold if it shares one of a template's heaviest terms (the rest of the
template's vector is shorter than the threshold), so one regular expression over those terms skips all other texts and
sentences without losing a match.

Evidence of a licence file, as a whole: its text is compared with the full licence texts (``license_texts``) by the cosine
of TF-IDF vectors of word pairs, which line breaks, years and names hardly change. Document frequencies are those among the
full texts, so what all licences share counts little. Full texts from ``MIN_WHOLE`` on and within ``MARGIN`` of the best are
candidates. The title in the file's first words (of any known licence, ``TITLES``) chooses among them; without a title there
must be one candidate only. A title that names none of them contradicts the match. Such a match comes before any sentence (a licence's title, or a licence that its text names); a file whose title
contradicts its match has no evidence at all rather than a wrong one. A file of several licences gives the one that makes up nearly
all of it, else what its sentences say.

Inheritance: a file without evidence of its own takes the licence of the nearest ancestor directory that has a licence
file with evidence, found by joining the directories' ancestors to the licensed directories.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duotower.llm.common import columns, written
from duotower.llm.quality import let

MIN_COSINE = 0.6
SALTS = 32
# Usual short notices and opening sentences of well-known licences.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "You may not use this file except in compliance with the License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    # the sentence of the standard file headers
    *[(name, "This program is free software; you can redistribute it and/or modify it under the terms of the " + title + " as published by the "
       "Free Software Foundation; either version " + version + " of the License, or (at your option) any later version.")
      for name, title, version in (("AGPL-3.0", "GNU Affero General Public License", "3"), ("GPL-2.0", "GNU General Public License", "2"),
                                   ("GPL-3.0", "GNU General Public License", "3"), ("LGPL-2.1", "GNU Lesser General Public License", "2.1"),
                                   ("LGPL-3.0", "GNU Lesser General Public License", "3"))],
)
# AGPL-3.0 is GPL-3.0 under its own name with this paragraph in section 13; its full text is made from these two.
_AGPL_13 = """Remote Network Interaction; Use with the GNU General Public License. Notwithstanding any other provision of this License, if
you modify the Program, your modified version must prominently offer all users interacting with it remotely through a computer network (if your
version supports such interaction) an opportunity to receive the Corresponding Source of your version by providing access to the Corresponding
Source from a network server at no charge, through some standard or customary means of facilitating copying of software."""
# What CC BY 4.0 and CC BY-NC 4.0 have instead of CC BY-SA 4.0's parts; their full texts are made from that one by rule.
_CC_NC = """NonCommercial means not primarily intended for or directed towards commercial advantage or monetary compensation. For
purposes of this Public License, the exchange of the Licensed Material for other material subject to Copyright and Similar Rights by
digital file-sharing or similar means is NonCommercial provided there is no payment of monetary compensation in connection with the
exchange."""
# The advertising clause of the four-clause BSD licence.
_BSD_4 = """All advertising materials mentioning features or use of this software must display the following acknowledgement: This
product includes software developed by the organization."""
MIN_WHOLE = 0.9
MARGIN = 0.02
HEAD_WORDS = 40
# Titles as they stand in the first words of a licence file, in words; also of licences without a full text here.
TITLES = (
    ("AGPL-3.0", "gnu affero general public license version 3"), ("Apache-1.1", "apache software license version 1 1"),
    ("Apache-2.0", "apache license version 2 0"), ("Artistic-1.0", "the artistic license"), ("Artistic-2.0", "artistic license 2 0"),
    ("BSD-2-Clause", "bsd 2 clause"), ("BSD-3-Clause", "bsd 3 clause"), ("BSD-4-Clause", "bsd 4 clause"), ("BSL-1.0", "boost software license version 1 0"),
    ("CC-BY-3.0", "attribution 3 0 unported"), ("CC-BY-4.0", "attribution 4 0 international"),
    ("CC-BY-NC-4.0", "attribution noncommercial 4 0 international"), ("CC-BY-NC-ND-4.0", "attribution noncommercial noderivatives 4 0 international"),
    ("CC-BY-NC-SA-4.0", "attribution noncommercial sharealike 4 0 international"), ("CC-BY-ND-4.0", "attribution noderivatives 4 0 international"),
    ("CC-BY-SA-3.0", "attribution sharealike 3 0 unported"), ("CC-BY-SA-4.0", "attribution sharealike 4 0 international"), ("CC0-1.0", "cc0 1 0 universal"),
    ("EPL-1.0", "eclipse public license v 1 0"), ("EPL-2.0", "eclipse public license v 2 0"), ("GFDL", "gnu free documentation license"),
    ("GPL-1.0", "gnu general public license version 1"), ("GPL-2.0", "gnu general public license version 2"), ("GPL-3.0", "gnu general public license version 3"),
    ("ISC", "isc license"), ("LGPL-2.0", "gnu library general public license version 2"), ("LGPL-2.1", "gnu lesser general public license version 2 1"),
    ("LGPL-3.0", "gnu lesser general public license version 3"), ("MIT", "mit license"), ("MIT-0", "mit no attribution"), ("MPL-1.0", "mozilla public license version 1 0"),
    ("MPL-1.1", "mozilla public license version 1 1"), ("MPL-2.0", "mozilla public license version 2 0"), ("NCSA", "university of illinois ncsa open source license"),
    ("OFL-1.0", "sil open font license version 1 0"), ("OFL-1.1", "sil open font license version 1 1"), ("Zlib", "zlib license"),
)
LICENSE_FILE = r"(?i)^(?:un)?(?:licen[cs]e|copying|notice)(?:[.-][a-z0-9.-]*)?$"
_OWNER = r"(?im)^[^a-z0-9\n]*copyright\s*(?:\(c\)|<|[0-9]{4}).*$"      # lines that name the owner, left out of whole texts
_TERM = r"[\p{L}\p{N}]+"
_SENTENCE_END = r"(?<=[.!?;])\s+|\n+"
_MARK = r"(?m)^[ \t]*(?:/\*+|\*+/|\*+|//+!?|#+|;+|--+|%+|<!--|dnl\b|REM\b)?[ \t]*|[ \t\r]*(?:\*+/|-->)?[ \t\r]*$"
_PARAGRAPH_END = r"(?<=[.!?])\s+|\n\s*\n"


def terms(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(f"({_TERM})"))


def template_terms(text: str) -> list[str]:
    return re.findall(r"[^\W_]+", text.lower())


def full_texts() -> list[tuple[str, str]]:
    """(license, text) of the full licence texts, read on the driver."""
    texts = {f.stem: f.read_text(encoding="utf-8") for f in sorted(Path(__file__).with_name("license_texts").glob("*.txt"))}
    own = re.sub(r"(?i)\bGNU\s+General\s+Public\s+License", "GNU Affero General Public License", texts["GPL-3.0"])
    paragraphs = re.split(r"\n\s*\n", texts["CC-BY-SA-4.0"])
    alike = re.compile(r"ShareAlike\.$|BY-SA\s+Compatible|In addition to the conditions in Section 3\(a\)")
    by = re.sub(r"-ShareAlike| and ShareAlike", "", "\n\n".join(p for p in paragraphs if not alike.search(p.strip())))
    nc = by.replace("Attribution 4.0", "Attribution-NonCommercial 4.0").replace("are Attribution.", "are Attribution and NonCommercial.")
    nc = re.sub(r"(reproduce and Share the Licensed Material, in whole or\s+in part)", r"\1, for NonCommercial purposes only", nc)
    nc = nc.replace("produce, reproduce, and Share Adapted Material", "produce, reproduce, and Share Adapted Material for NonCommercial purposes only")
    return [*texts.items(), ("AGPL-3.0", own + _AGPL_13), ("CC-BY-4.0", by), ("CC-BY-NC-4.0", nc + "\n\n" + _CC_NC),
            ("BSD-4-Clause", texts["BSD-3-Clause"] + "\n\n" + _BSD_4)]


class FullTexts:
    """TF-IDF vectors of the full texts' word pairs."""

    def __init__(self):
        self.counts = {}
        for name, text in full_texts():
            words = template_terms(re.sub(_OWNER, "", text))
            self.counts[name] = Counter(f"{a} {b}" for a, b in zip(words, words[1:]))
        self.n = len(self.counts)
        df = Counter(pair for c in self.counts.values() for pair in c)
        self.idf = {pair: math.log((1 + self.n) / k) for pair, k in df.items()}
        self.other = math.log(1 + self.n)      # a pair of no full text

    def weights(self) -> list[tuple[str, str, float]]:
        """(pair, license, weight) with weights of length one per licence."""
        out = []
        for name, c in self.counts.items():
            norm = math.sqrt(sum((n * self.idf[p]) ** 2 for p, n in c.items()))
            out += [(p, name, n * self.idf[p] / norm) for p, n in c.items()]
        return out


def claimed_title(ts: Column) -> Column:
    """The licence whose title comes first in the head of a text (of equal starts the longest title), or null."""
    head = F.concat(F.lit(" "), F.array_join(F.slice(ts, 1, HEAD_WORDS), " "), F.lit(" "))
    found = F.array(*[F.struct(F.instr(head, f" {title} ").alias("at"), F.lit(-len(title)).alias("size"), F.lit(name).alias("name")) for name, title in TITLES])
    return F.array_min(F.filter(found, lambda t: t["at"] > 0))["name"]


def whole_matches(licenses: DataFrame) -> DataFrame:
    """(row, whole): struct(cosine, license) of the full text that a licence file (row, text) is a copy of. ``license`` is null
    where the title contradicts the nearest text; files without a match have no row."""
    model = FullTexts()
    spark = licenses.sparkSession
    table = F.broadcast(spark.createDataFrame(model.weights(), "pair string, license string, weight double"))      # the shipped texts only
    idf = F.broadcast(spark.createDataFrame(list(model.idf.items()), "pair string, idf double"))
    ts = terms(F.regexp_replace("text", _OWNER, ""))
    words = licenses.select("row", ts.alias("ts")).where(F.size("ts") > 1).withColumn("title", claimed_title(F.col("ts")))
    pairs = F.zip_with(F.slice("ts", 1, F.size("ts") - 1), F.slice("ts", 2, F.size("ts") - 1), lambda a, b: F.concat_ws(" ", a, b))
    counts = (words.select("row", "title", F.explode(pairs).alias("pair")).groupBy("row", "pair")
              .agg(F.count(F.lit(1)).cast("double").alias("n"), F.max("title").alias("title")))
    counts = written(counts.join(idf, "pair", "left").withColumn("w", F.col("n") * F.coalesce("idf", F.lit(model.other))).drop("n"), "license_pairs")
    norms = counts.groupBy("row").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"), F.max("title").alias("title"))
    dots = (counts.where(F.col("idf").isNotNull()).join(table, "pair").groupBy("row", "license").agg(F.sum(F.col("w") * F.col("weight")).alias("dot")))
    # at most as many rows as licence files times full texts
    cosine = dots.join(norms, "row").select("row", "title", F.struct(F.round(F.col("dot") / F.col("norm"), 9).alias("cosine"), "license").alias("one"))
    ranked = cosine.groupBy("row").agg(F.max("title").alias("title"), F.sort_array(F.collect_list("one"), False).alias("all"))
    best, title = F.col("all")[0], F.col("title")
    near = F.filter("all", lambda o: (o["cosine"] >= MIN_WHOLE) & (o["cosine"] >= best["cosine"] - MARGIN))
    titled = F.get(F.filter(near, lambda o: o["license"] == title), F.lit(0))
    sure = F.when(title.isNotNull(), titled).when(F.size(near) == 1, best)
    refused = F.when(title.isNotNull() & (best["cosine"] >= MIN_COSINE) & (best["license"] != title),
                     F.struct(best["cosine"].alias("cosine"), F.lit(None).cast("string").alias("license")))
    return ranked.select("row", F.coalesce(sure, refused).alias("whole")).where(F.col("whole").isNotNull())


class Model:
    """TF-IDF vectors of the templates for given document frequencies."""

    def __init__(self, frequency: dict[str, int], n_files: int, templates, min_cosine: float):
        self.terms = sorted({t for _, text in templates for t in template_terms(text)})
        self.idf = [math.log((1 + n_files) / (1 + frequency.get(t, 0))) + 1 for t in self.terms]
        self.other = math.log(1 + n_files) + 1      # a term of no template
        at = {t: k for k, t in enumerate(self.terms)}
        self.vectors, heavy = [], set()
        for name, text in templates:
            counts: dict[int, int] = {}
            for t in template_terms(text):
                counts[at[t]] = counts.get(at[t], 0) + 1
            vector = {k: n * self.idf[k] for k, n in counts.items()}
            norm = math.sqrt(sum(w * w for w in vector.values()))
            vector = {k: w / norm for k, w in vector.items()}
            self.vectors.append((name, text, vector))
            left = 1.0
            for k, w in sorted(vector.items(), key=lambda x: (-x[1], x[0])):
                if math.sqrt(max(0.0, left)) < min_cosine - 1e-9:
                    break
                heavy.add(self.terms[k])
                left -= w * w
        self.heavy = sorted(heavy)

    def heavy_regex(self) -> str:
        return r"(?<![\p{L}\p{N}])(?:" + "|".join(self.heavy) + r")(?![\p{L}\p{N}])"


def best_match(unit: Column, model: Model, min_cosine: float) -> Column:
    """struct(cosine, license) of the best template for a text, or null below the threshold."""
    vocabulary = F.array(*[F.lit(t) for t in model.terms])

    def score(ts: Column) -> Column:
        counts = F.transform(vocabulary, lambda t: F.size(F.filter(ts, lambda x: x == t)).cast("double"))
        # other terms, sorted: (term, run so far, squares of the runs before)
        others = F.array_sort(F.filter(ts, lambda x: ~F.array_contains(vocabulary, x)))
        start = F.struct(F.lit("").alias("t"), F.lit(0.0).alias("run"), F.lit(0.0).alias("sum"))
        squares = F.aggregate(others, start, lambda a, x: F.struct(
            x.alias("t"), F.when(a["t"] == x, a["run"] + 1.0).otherwise(F.lit(1.0)).alias("run"),
            F.when(a["t"] == x, a["sum"]).otherwise(a["sum"] + a["run"] * a["run"]).alias("sum")), lambda a: a["sum"] + a["run"] * a["run"])
        weights = F.zip_with(counts, F.array(*[F.lit(v) for v in model.idf]), lambda c, v: c * v)

        def best(w: Column) -> Column:
            norm = F.sqrt(F.aggregate(w, F.lit(0.0), lambda a, x: a + x * x) + F.lit(model.other * model.other) * squares)
            cosines = []
            for name, _, vector in model.vectors:
                dot = F.lit(0.0)
                for k, v in sorted(vector.items()):
                    dot = dot + w[k] * F.lit(v)
                cosines.append(F.struct(F.round(dot / norm, 9).alias("cosine"), F.lit(name).alias("license")))
            return F.array_max(F.filter(F.array(*cosines), lambda c: c["cosine"] >= min_cosine))

        return let(weights, best)

    return let(terms(unit), score)


def scan(files: DataFrame, id_col: str = "doc_id", path_col: str = "path", text_col: str = "text", templates=TEMPLATES, min_cosine: float = MIN_COSINE
         ) -> DataFrame:
    """One row per file: id, path, license, cosine, found ('own', 'inherited' or null), license_dir.

    ``own``: for a licence file its full text, else the best template at or above ``min_cosine`` (ties: the greater
    licence name). ``inherited``: that of
    the best licence file in the nearest ancestor directory (the file's own directory first). Paths are separated by
    ``/``; a licence file's name is LICENSE, COPYING or NOTICE with any ending.

    Defined results: null or empty texts have no evidence; a null path has no directory and inherits nothing; repeated
    rows give one row each; an empty table gives no rows; other columns are ignored.
    """
    files = columns(files, doc_id=id_col, path=path_col, text=text_col)
    vocabulary = sorted({t for _, text in templates for t in template_terms(text)})
    known = F.array(*[F.lit(t) for t in vocabulary])
    # one row per term of the templates, and the number of files
    counted = (files.select(F.explode(F.concat(F.array_intersect(F.coalesce(terms(F.col("text")), F.array()), known), F.array(F.lit("")))).alias("term"))
               .groupBy("term").count().collect())
    frequency = {r["term"]: r["count"] for r in counted}
    model = Model(frequency, frequency.get("", 0), templates, min_cosine)

    heavy = F.lit(model.heavy_regex())
    name = F.element_at(F.split("path", "/"), -1)
    text = F.col("text")
    sentences = F.filter(F.split(text, _SENTENCE_END, -1), lambda s: F.regexp_like(F.lower(s), heavy))
    whole = F.when(F.regexp_like(name, F.lit(LICENSE_FILE)), F.array(text)).otherwise(F.array().cast("array<string>"))
    joined = F.filter(F.split(F.regexp_replace(text, _MARK, ""), _PARAGRAPH_END, -1), lambda s: s.contains("\n") & F.regexp_like(F.lower(s), heavy))
    units = F.when(F.regexp_like(F.lower(text), heavy), F.concat(sentences, joined, whole))
    evidence = F.array_max(F.transform(units, lambda u: best_match(u, model, min_cosine)))
    slash = F.col("path").contains("/")
    directory = F.when(F.col("path").isNotNull(), F.when(slash, F.regexp_replace("path", "/[^/]*$", "")).otherwise(F.lit("")))
    scanned = files.select("doc_id", "path", directory.alias("dir"), F.coalesce(F.regexp_like(name, F.lit(LICENSE_FILE)), F.lit(False)).alias("is_license"),
                           evidence.alias("evidence"), F.when(F.regexp_like(name, F.lit(LICENSE_FILE)), text).alias("text"),
                           F.monotonically_increasing_id().alias("row"))
    scanned = written(scanned, "license_evidence")
    found = whole_matches(scanned.where("is_license and text is not null").select("row", "text"))
    scanned = scanned.drop("text").join(found, "row", "left").withColumn("from_whole", F.col("whole").isNotNull())
    scanned = scanned.withColumn("evidence", F.when(F.col("whole").isNull(), F.col("evidence")).when(F.col("whole.license").isNotNull(), F.col("whole"))).drop("whole")

    licensed = scanned.where("is_license and evidence is not null").groupBy("dir").agg(F.max_by("evidence", F.struct("from_whole", "evidence")).alias("granted"))
    # ancestors of every distinct directory, the directory itself first, the root ('') last
    dirs = scanned.where("dir is not null").select("dir").distinct()
    parts = F.split("dir", "/")
    ups = F.when(F.col("dir") == "", F.array(F.lit(""))).otherwise(F.concat(
        F.transform(F.sequence(F.lit(0), F.size(parts) - 1), lambda k: F.array_join(F.slice(parts, 1, F.size(parts) - k), "/")), F.array(F.lit(""))))
    # an ancestor near the root is that of very many directories, and a directory may hold very many files: keys are salted
    salts = F.explode(F.array(*[F.lit(k) for k in range(SALTS)])).alias("salt")
    chain = dirs.select("dir", F.posexplode(ups).alias("up", "ancestor")).withColumn("salt", F.pmod(F.xxhash64("dir"), F.lit(SALTS)).cast("int"))
    granting = licensed.select(F.col("dir").alias("ancestor"), "granted", salts)
    nearest = chain.join(granting, ["ancestor", "salt"]).groupBy("dir").agg(F.min_by(F.struct("granted", "ancestor"), "up").alias("from"))
    scanned = scanned.withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(SALTS)).cast("int"))
    some = scanned.where("dir is not null").select("dir", "salt").distinct().join(nearest, "dir")      # SALTS rows per directory at most
    spread = F.coalesce(F.col("dir"), F.concat(F.lit("\n"), F.col("row").cast("string")))             # null paths meet nothing, spread out
    out = scanned.withColumn("key", spread).join(some.withColumnRenamed("dir", "key"), ["key", "salt"], "left")
    own = F.col("evidence").isNotNull()
    return out.select(
        "doc_id", "path", F.coalesce("evidence.license", "from.granted.license").alias("license"),
        F.coalesce("evidence.cosine", "from.granted.cosine").alias("cosine"),
        F.when(own, F.lit("own")).when(F.col("from").isNotNull(), F.lit("inherited")).alias("found"),
        F.when(~own, F.col("from.ancestor")).alias("license_dir"))
