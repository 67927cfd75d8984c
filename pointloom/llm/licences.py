"""License scans: TF-IDF cosine of passages to licence templates, then inheritance from the nearest directory.

Every text is read whole. Comment marks are taken off its lines; its passages are the sentences of single lines and those
of paragraphs whose wrapped lines are joined. Each passage with a cue of a licence is compared with all templates. Weights
are term frequency times inverse document frequency, with the true frequencies of all terms over all files. A passage of at
least `least` cosine names its licence, unless two licences fit equally well, it says that something is not licensed, or it
is but the name of a licence of several versions. SPDX
tags name theirs with score 1. A file's licence is that of its best passage; `licences` lists all. A licence file also gives
its licence to its directory (the best score, then the first path), and a file without one of its own takes that of its
nearest ancestor directory that has one.

Only DataFrame functions are used. Equal passages are scored once. The templates are a fixed list, so their vectors are
broadcast; passages meet the frequencies of their terms in a shuffled join. Directories, not files, are joined with their
ancestors. Null and empty texts have no licence of their own, nor does an empty table give any rows; a null path is in no
directory. Very long texts are cut into passages like others. Repeated rows get equal results, of equal scores the greatest
licence and sentence count. Columns of the same names are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pointloom.llm.common import materialize

# How licences are stated, by identifier: short grants, titles, standard headers and first sentences of texts.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License."),
    ("Apache-2.0", "Apache License Version 2.0, January 2004"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "The MIT License (MIT)"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "GNU General Public License Version 3"),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "GNU General Public License Version 2"),
    ("GPL-2.0", "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation;"),
    ("LGPL-2.1", "This library is licensed under the GNU Lesser General Public License, version 2.1."),
    ("LGPL-2.1", "GNU Lesser General Public License Version 2.1"),
    ("LGPL-2.1", "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation;"),
    ("LGPL-3.0", "GNU Lesser General Public License Version 3"),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "Released under CC0 1.0, dedicated to the public domain."),
    # names without a version fit these best, and so name no licence
    ("", "GNU General Public License"),
    ("", "GNU Lesser General Public License"),
    ("", "GNU Affero General Public License"),
]
CUE = r"(?i)licen[sc]e|permission is|redistribution|public domain|source code form"
DENIED = r"(?i)(?:\b(?:not|never|no longer)|n't)\s+(?:\w+\s+){0,2}(?:licen[sc]ed|released|distributed|available|covered|granted|subject|dedicated|under)\b"
TERM = r"[a-z0-9]+(?:[.-][a-z0-9]+)*"
MARKS = r"^\s*(?:/\*+|\*+/?|//+|#+|--+|;+|%+|<!--|>+)?\s*|\s*(?:\*+/|-->)?\s*$"
WRAPPED = r"(?<!\n)\n(?!\n)"
CUT = r"\n+|(?<=[.!?;])\s+(?![0-9])"
TAG = r"(?i)SPDX-License-Identifier:\s*(\(*[a-z0-9.+-]+\)*(?: +(?:or|and|with) +\(*[a-z0-9.+-]+\)*)*)"
LICENCE_FILE = r"(?i)^(licen[sc]e|copying|notice)([.-].*)?$"
LEAST = 0.75


def terms(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(f"({TERM})"), F.lit(1))


def passages(text: Column) -> Column:
    """The different passages of a text that hold a cue, as an array."""
    lines = F.array_join(F.transform(F.split(text, r"\r?\n"), lambda x: F.regexp_replace(x, MARKS, "")), "\n")
    pieces = F.concat(F.split(lines, CUT), F.split(F.regexp_replace(lines, WRAPPED, " "), CUT))
    told = F.filter(pieces, lambda p: p.rlike(CUE) & ~p.rlike(DENIED) & ~p.rlike(TAG))
    return F.when(text.rlike(CUE), F.array_distinct(F.transform(told, F.trim)))


def tags(text: Column) -> Column:
    """Identifiers named by SPDX tags, as an array. Exceptions, and whether later versions are allowed, are left out."""
    found = F.when(text.rlike(CUE), F.regexp_extract_all(text, F.lit(TAG), F.lit(1)))
    alone = F.transform(found, lambda e: F.regexp_replace(e, r"(?i) with +[^ ]+|[()]", ""))
    names = F.flatten(F.transform(alone, lambda e: F.split(e, r"(?i) +(?:or|and) +")))
    return F.array_distinct(F.transform(names, lambda x: F.regexp_replace(F.trim(x), r"(?:-only|-or-later|[+.])+$", "")))


def term_frequencies(files: DataFrame, text: str) -> DataFrame:
    """(term, df): the number of files that hold a term."""
    return files.select(F.explode(F.array_distinct(terms(F.col(text)))).alias("term")).groupBy("term").agg(F.count("*").alias("df"))


def unit_vectors(texts: DataFrame, key: str, frequencies: DataFrame, n: int) -> DataFrame:
    """(key, term, w) of texts (key, text): unit vectors of term frequency times inverse document frequency."""
    counts = texts.select(key, F.explode(terms(F.col("text"))).alias("term")).groupBy(key, "term").agg(F.count("*").alias("n"))
    idf = F.log(F.lit(1.0 + n) / (F.coalesce("df", F.lit(0)) + 1)) + 1
    weighed = counts.join(frequencies, "term", "left").select(key, "term", (F.col("n") * idf).alias("w"))
    norms = weighed.groupBy(key).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    return weighed.join(norms, key).select(key, "term", (F.col("w") / F.col("norm")).alias("w"))


def named(texts: DataFrame, frequencies: DataFrame, n: int, least: float) -> DataFrame:
    """(passage, licence, score) of different passages (passage_id, text) of at least `least` cosine to one licence."""
    spark = texts.sparkSession
    listed = spark.range(1).select(F.inline(F.array(*[
        F.struct(F.lit(i).alias("template"), F.lit(name).alias("licence"), F.lit(t).alias("text")) for i, (name, t) in enumerate(TEMPLATES)
    ])))
    ours = unit_vectors(listed, "template", frequencies, n).withColumnRenamed("w", "tw")
    ours = F.broadcast(ours.join(listed.select("template", "licence"), "template"))  # as many rows as the templates have terms
    cosines = unit_vectors(texts, "passage_id", frequencies, n).join(ours, "term").groupBy("passage_id", "template", "licence").agg(
        F.round(F.sum(F.col("w") * F.col("tw")), 6).alias("score")
    ).where(F.col("score") >= least)
    fits = cosines.groupBy("passage_id", "licence").agg(F.max("score").alias("score"))  # a row a licence at most
    best = fits.groupBy("passage_id").agg(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), "licence"))).alias("l"))
    first, second = F.get("l", F.lit(0)), F.get("l", F.lit(1))
    sure = best.where((first["licence"] != "") & (second["s"].isNull() | (second["s"] > first["s"])))
    return sure.join(texts, "passage_id").select(F.col("text").alias("passage"), first["licence"].alias("licence"), (-first["s"]).alias("score"))


def scan(files: DataFrame, path: Column, licence_file: Column | None = None, text: str = "text", least: float = LEAST, keep: list[str] | None = None) -> DataFrame:
    """Kept columns (default: all but the text) and path, licence, licences, score, sentence, inherited, inherited_from, final.

    `licence_file` says which rows are licence files, and may use `path` and all columns of `files`; by default their name
    does. They give a licence only if they have one.
    """
    names = {"path", "licence", "licences", "score", "sentence", "inherited", "inherited_from", "final", "_id", "_passages", "_tags", "_dir", "_gives"}
    kept = [c for c in (files.columns if keep is None else keep) if c.lower() not in names and c != text]
    name = F.element_at(F.split("path", "/"), -1)
    gives = name.rlike(LICENCE_FILE) if licence_file is None else licence_file
    read = files.withColumn("path", path).select(
        *kept, "path", F.coalesce(gives, F.lit(False)).alias("_gives"), F.regexp_replace("path", r"/?[^/]*$", "").alias("_dir"),
        passages(F.col(text)).alias("_passages"), tags(F.col(text)).alias("_tags"), F.monotonically_increasing_id().alias("_id"),
    )
    read = materialize(read, "licences")  # fixes the ids
    told = read.select("_id", F.explode("_passages").alias("passage"))
    texts = materialize(told.select(F.col("passage").alias("text")).distinct().withColumn("passage_id", F.monotonically_increasing_id()), "passages")
    frequencies = materialize(term_frequencies(files, text), "frequencies")
    stated = told.join(materialize(named(texts, frequencies, files.count(), least), "named"), "passage").select(
        "_id", "score", "licence", F.col("passage").alias("sentence")
    ).unionByName(
        read.select("_id", F.lit(1.0).alias("score"), F.explode("_tags").alias("licence")).withColumn(
            "sentence", F.concat(F.lit("SPDX-License-Identifier: "), "licence")
        )
    )
    own = stated.groupBy("_id").agg(
        F.max(F.struct("score", "licence", "sentence")).alias("b"), F.array_sort(F.collect_set("licence")).alias("licences")
    ).select("_id", "b.*", "licences")
    found = read.drop("_passages", "_tags").join(own, "_id", "left").withColumn("_gives", F.col("_gives") & F.col("licence").isNotNull())
    found = materialize(found.drop("_id"), "stated")
    given = found.where("_gives").groupBy("_dir").agg(
        F.min(F.struct((-F.col("score")).alias("s"), "path", "licence")).alias("g")
    ).select(F.col("_dir").alias("ancestor"), F.col("g.licence").alias("inherited"), F.col("g.path").alias("inherited_from"))
    parts = F.split("_dir", "/")
    above = found.select("_dir").where("_dir is not null").distinct().select(
        "_dir", F.explode(F.sequence(F.lit(0), F.size(parts))).alias("depth"), parts.alias("parts")
    ).select("_dir", "depth", F.array_join(F.slice("parts", F.lit(1), F.col("depth")), "/").alias("ancestor"))
    nearest = above.join(materialize(given, "given"), "ancestor").groupBy("_dir").agg(
        F.max(F.struct("depth", "inherited", "inherited_from")).alias("n")
    ).select("_dir", "n.inherited", "n.inherited_from")
    return found.join(materialize(nearest, "nearest"), "_dir", "left").select(
        *kept, "path", "licence", "licences", "score", "sentence", "inherited", "inherited_from", F.coalesce("licence", "inherited").alias("final")
    )


def document_path(source: Column, lang: Column, doc_id: Column) -> Column:
    """Where a document stands in a tree: by source and language, two thirds in blocks of a thousand ids, half of those deeper."""
    block = F.floor(doc_id / 1000).cast("string")
    third = F.pmod(doc_id, F.lit(3))
    return F.concat_ws(
        "/", F.coalesce(source, F.lit("none")), F.coalesce(lang, F.lit("none")), F.when(third > 0, block),
        F.when(third == 2, F.lit("sub")), F.coalesce(doc_id.cast("string"), F.lit("none")),
    )


def op4_licences(docs: DataFrame) -> DataFrame:
    """Documents as files of a tree; those of at most 60 words that state a licence are its licence files."""
    short = F.regexp_count("text", F.lit(r"\S+")) <= 60
    files = docs.select("doc_id", "text", "source", "lang")
    return scan(files, document_path(F.col("source"), F.col("lang"), F.col("doc_id")), short, keep=["doc_id"])
