"""License scans: sparse TF-IDF cosine to templates, then inheritance from the
nearest ancestor directory that has a licence file.

Every line of a file is a header candidate, and so is every sentence of a block
of neighbouring lines (comment marks removed), whole and cut where a notice
begins; a licence file (LICENSE, LICENCE, COPYING, NOTICE, UNLICENSE, with any
extension) is compared as a whole as well.
Vectors hold the words of the template vocabulary, weighted by term frequency
and the inverse document frequency over all files; other words lengthen a
vector, each distinct one as a word seen nowhere else.  Of the templates at a
cosine of at least ``SIMILAR`` the one with the most distinct words in common
names the file's licence (ties: the larger cosine, then the earlier template).
A template names its family and version words, without which it does not match,
and words of neighbouring families, with which it does not: an unknown version
or family has no verdict.  A file without one takes that of the
nearest directory, its own included, whose licence file has one; directories
and ancestors are joined by path.

Defined cases: null and empty texts have no licence of their own; a null path
inherits nothing; a path without a slash lies in the root; of several licence
files in one directory the best match counts, ties going to the smaller
template name; repeated rows give repeated results; empty tables give no rows;
texts of any length are compared whole; a null doc_id is kept; only doc_id and
text are read, so names of other columns cannot clash.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F

from ledgerlens.llm.native import let, row_key, same, written

SIMILAR = 0.6

#: SPDX name, a customary notice, title or sentence, words that a
#: match must hold and words that it must not hold.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0.", "apache 2", ""),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in "
                   "compliance with the License.", "apache 2", ""),
    ("MIT", "Released under the MIT License.", "mit license", ""),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files, to deal in the Software without restriction.", "granted charge", ""),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3.", "gnu 3", "lesser affero"),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                "General Public License as published by the Free Software Foundation, either version 3.",
     "gnu 3", "lesser affero"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2.", "gnu 2", "lesser affero"),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU "
                "General Public License as published by the Free Software Foundation; either version 2.",
     "gnu 2", "lesser affero"),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3.", "lesser 3", ""),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted "
                     "provided that the following conditions are met.", "redistribution binary", ""),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "mozilla 2", ""),
    ("Unlicense", "This is free and unencumbered software released into the public domain.", "unencumbered", ""),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                 "Affero General Public License as published by the Free Software Foundation, either version 3.",
     "affero 3", ""),
    ("AGPL-3.0", "GNU Affero General Public License, version 3.", "gnu affero 3", ""),
    ("LGPL-3.0", "This library is free software: you can redistribute it and/or modify it under the terms of the GNU "
                 "Lesser General Public License as published by the Free Software Foundation, either version 3.",
     "lesser 3", ""),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU "
                 "Lesser General Public License as published by the Free Software Foundation; either version 2.1.",
     "lesser 2 1", ""),
    ("LGPL-2.1", "GNU Lesser General Public License, version 2.1.", "gnu lesser 2 1", ""),
    ("LGPL-3.0", "GNU Lesser General Public License, version 3.", "gnu lesser 3", ""),
    ("GPL-3.0", "GNU General Public License, version 3, 29 June 2007.", "gnu 3 2007", "lesser affero"),
    ("GPL-2.0", "GNU General Public License, version 2, June 1991.", "gnu 2 1991", "lesser affero"),
    ("Apache-2.0", "Apache License, version 2.0, January 2004.", "apache 2 2004", ""),
    ("Apache-1.1", "The Apache Software License, Version 1.1.", "apache 1", ""),
    ("BSD-2-Clause", "Redistributions in binary form must reproduce the above copyright notice, this list of conditions "
                     "and the following disclaimer in the documentation and/or other materials provided with the "
                     "distribution.", "redistributions binary reproduce", ""),
    ("BSD-3-Clause", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse "
                     "or promote products derived from this software without specific prior written permission.",
     "endorse promote", ""),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
            "hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
     "fee granted", ""),
    ("ISC", "ISC License.", "isc license", ""),
    ("MPL-2.0", "Mozilla Public License, version 2.0.", "mozilla 2", ""),
    ("MPL-1.1", "The contents of this file are subject to the Mozilla Public License, Version 1.1.", "mozilla 1", ""),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public "
                "License 2.0.", "eclipse 2", ""),
    ("EPL-2.0", "Eclipse Public License, v 2.0.", "eclipse 2", ""),
    ("EPL-1.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public "
                "License v1.0.", "eclipse 1", ""),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0.", "boost 1", ""),
    ("Zlib", "Permission is granted to anyone to use this software for any purpose, including commercial applications, "
             "and to alter it and redistribute it freely.", "alter freely", ""),
    ("CC0-1.0", "CC0 1.0 Universal, public domain dedication.", "cc0", ""),
]
#: Where a notice may begin inside a sentence.
_STARTS = sorted({r"\s+".join(t.split()[:2]) for _, t, _, _ in TEMPLATES if t.split()[0] in (
    "Licensed", "Released", "Permission", "This", "Redistribution", "Redistributions", "Neither", "Distributed")})
#: Parts of the Creative Commons names: short form, long form.
_CC = {"nc": "NonCommercial", "sa": "ShareAlike", "nd": "NoDerivatives"}
for _version in ("4.0", "3.0"):
    for _parts in ((), ("sa",), ("nc",), ("nd",), ("nc", "sa"), ("nc", "nd")):
        _name = "-".join(["CC", "BY", *(p.upper() for p in _parts)]) + f"-{_version}"
        _short = "CC BY" + "".join(f"-{p.upper()}" for p in _parts)
        _long = "Creative Commons Attribution" + "".join(f"-{_CC[p]}" for p in _parts)
        _not = [p for p in _CC if p not in _parts]
        TEMPLATES += [
            (_name, f"Licensed under {_short} {_version}.", " ".join(["cc", _version[0], *_parts]), " ".join(_not)),
            (_name, f"This work is licensed under a {_long} {_version} International License.",
             " ".join(["attribution", _version[0], *(_CC[p].lower() for p in _parts)]), " ".join(_CC[p].lower() for p in _not))]
#: An identifier line names any of them; "only" and "or later" do not change the name.
for _name in sorted({n for n, *_ in TEMPLATES}):
    _words = re.findall(r"[a-z0-9]+", _name.lower())
    TEMPLATES += [(_name, f"SPDX-License-Identifier: {_name}{_tail}", " ".join(["spdx", *(w for w in _words if w != "by")]),
                   " ".join(p for p in _CC if p not in _words) if _name.startswith("CC-BY") else "")
                  for _tail in (("", "-only", "-or-later") if "GPL" in _name else ("",))]
#: Words that tell no licences apart.
STOP_WORDS = ("a", "an", "and", "any", "are", "as", "at", "be", "by", "can", "either", "except", "for", "from", "in",
              "into", "is", "it", "of", "on", "or", "the", "this", "to", "under", "with", "you")
#: Ends of a sentence, but not "v." before a number; an empty line, bare comment marks included, ends one as well.
_SENTENCE_END = "\\n\\n+|(?<=[.!?])(?<!\\bv\\.)\\s+"
#: Where a template's first two words stand, and after a colon that ends a line.
_NOTICE_START = "(?i)(?=\\b(?:" + "|".join(_STARTS) + ")\\b)|(?<=:)[ \\t]*\\n"
_LICENCE_FILE = "(?i)(^|/)(un)?(licen[sc]e|copying|notice)(\\.[^/]*)?$"


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit("[\\p{L}\\p{N}]+"), F.lit(0))


def _template_words() -> list[tuple[int, str, list[str]]]:
    # "by" tells CC licences apart, so it stays where "cc" stands before it
    return [(i, name, [w for j, w in enumerate(ws) if w not in STOP_WORDS or (j and ws[j - 1] == "cc")])
            for i, (name, ws) in enumerate((n, re.findall(r"[^\W_]+", t.lower())) for n, t, _, _ in TEMPLATES)]


def _vocabulary() -> list[str]:
    barred = {w for *_, words in TEMPLATES for w in words.split()}
    return sorted({w for _, _, ws in _template_words() for w in ws if w not in STOP_WORDS} | barred)


def _telling() -> list[str]:
    """Of the words each template needs the longest: without any of these nothing matches."""
    return sorted({max((w for w in wanted.split() if not w.isdigit()), key=len) for _, _, wanted, _ in TEMPLATES})


def directory_of(path: Column) -> Column:
    return F.regexp_replace(path, "/?[^/]*$", "")


def _units(files: DataFrame) -> DataFrame:
    """file_id, key, path, unit, n_other and terms of the lines, sentences and
    notices (and whole licence files) that hold a word some template needs."""
    vocabulary = F.array(*map(F.lit, _vocabulary()))
    stop = F.array(*map(F.lit, (*STOP_WORDS, *_vocabulary())))
    lines = F.split("text", "\n", -1)
    bare = F.regexp_replace(F.regexp_replace("text", "\r\n?", "\n"), "(?m)^[^\\p{L}\\p{N}\\n]+", "")
    sentences = F.split(bare, _SENTENCE_END, -1)
    notices = F.flatten(F.transform("sentences", lambda x: F.split(x, _NOTICE_START, -1)))
    whole = F.when(F.col("path").rlike(_LICENCE_FILE), F.array(F.col("text"))).otherwise(F.array().cast("array<string>"))
    # most files hold none of the words that some template needs, and are not split
    telling = F.array(*map(F.lit, _telling()))
    some = let(F.lower("text"), lambda low: F.exists(telling, lambda w: F.contains(low, w)))
    parts = files.where(some).select("file_id", "key", "path", "text", sentences.alias("sentences"))
    unit = parts.select("file_id", "key", "path", F.posexplode(F.array_distinct(F.concat(
        lines, whole, "sentences", notices))).alias("unit", "line"))
    split = unit.select("file_id", "key", "path", "unit", words_of(F.col("line")).alias("words"))
    return split.where(F.arrays_overlap("words", telling)).select(
        "file_id", "key", "path", "unit", F.size(F.array_except("words", stop)).alias("n_other"),
        F.filter("words", lambda w: F.array_contains(vocabulary, w)).alias("terms")).distinct()


def own_licences(files: DataFrame, least: float = SIMILAR) -> DataFrame:
    """file_id, key, path, licence and cosine of the files that carry one.  ``files``: file_id, key, path, text."""
    spark = files.sparkSession
    units = written(_units(files), "licence-units")
    total = files.count()
    terms = units.select("file_id", "key", "path", "unit", "n_other", F.explode("terms").alias("term"))
    # in how many of all files a word stands; one row a word of the vocabulary: at most a few hundred
    known = F.array(*map(F.lit, _vocabulary()))
    seen = files.select(F.explode(F.array_intersect(words_of(F.col("text")), known)).alias("term")) \
        .groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    vocabulary = spark.createDataFrame([(w,) for w in _vocabulary()], "term string")
    idf = written(vocabulary.join(seen, "term", "left").select(
        "term", (F.log((F.lit(total) + 1) / (F.coalesce("df", F.lit(0)) + 1)) + 1).alias("idf")), "licence-idf")
    flat = [(i, name, w, 1, w in TEMPLATES[i][2].split(), False) for i, name, ws in _template_words() for w in ws
            if w not in STOP_WORDS]
    # words that a match must not hold weigh nothing
    flat += [(i, name, w, 0, False, True) for i, (name, _, _, barred) in enumerate(TEMPLATES) for w in barred.split()]
    weights = spark.createDataFrame(flat, "template int, licence string, term string, tf int, required boolean, "
                                          "barred boolean") \
        .groupBy("template", "licence", "term").agg(F.sum("tf").alias("tf"), F.max("required").alias("required"),
                                                    F.max("barred").alias("barred")).join(F.broadcast(idf), "term") \
        .select("template", "licence", "term", (F.col("tf") * F.col("idf")).alias("weight"), "required", "barred")
    lengths = weights.groupBy("template").agg(F.sqrt(F.sum(F.col("weight") ** 2)).alias("template_length"),
                                              F.count_if("required").alias("wanted"))
    templates = weights.join(F.broadcast(lengths), "template")
    unseen = F.log(F.lit(total) + 1) + 1
    vectors = terms.groupBy("file_id", "key", "path", "unit", "n_other", "term").agg(F.count(F.lit(1)).alias("tf")) \
        .join(F.broadcast(idf), "term").withColumn("w", F.col("tf") * F.col("idf"))
    unit = ["file_id", "key", "path", "unit", "n_other"]
    unit_lengths = vectors.groupBy(*unit).agg(F.collect_list(F.struct("term", "w")).alias("terms")).withColumn(
        "unit_length", F.sqrt(F.aggregate("terms", F.lit(0.0), lambda a, t: a + t["w"] * t["w"])
                              + F.col("n_other") * unseen * unseen))
    dots = unit_lengths.select("file_id", "key", "path", "unit", "unit_length", F.inline("terms")) \
        .join(F.broadcast(templates), "term").groupBy("file_id", "key", "path", "unit", "unit_length", "template",
                                                      "licence", "template_length", "wanted") \
        .agg(F.sum(F.col("w") * F.col("weight")).alias("dot"), F.count_if(~F.col("barred")).alias("matched"),
             F.count_if("required").alias("held"), F.count_if("barred").alias("barred")) \
        .where((F.col("held") == F.col("wanted")) & (F.col("barred") == 0))
    scored = dots.select("file_id", "key", "path", "licence", "template", "matched", F.round(
        F.col("dot") / (F.col("unit_length") * F.col("template_length")), 6).alias("cosine"))
    best = scored.where(F.col("cosine") >= least).groupBy("file_id", "key", "path").agg(
        F.max(F.struct("matched", "cosine", (-F.col("template")).alias("early"), "licence")).alias("best"))
    return best.select("file_id", "key", "path", F.col("best.licence").alias("licence"),
                       F.col("best.cosine").alias("cosine"))


def inherited_licences(directories: DataFrame, own: DataFrame) -> DataFrame:
    """directory, from_dir, licence and cosine: of the nearest ancestor with a licence file."""
    given = own.where(F.col("path").rlike(_LICENCE_FILE)).groupBy(directory_of(F.col("path")).alias("from_dir")).agg(
        F.max(F.struct("cosine", "licence")).alias("given"))
    parts = F.split("directory", "/", -1)
    ancestors = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/"))
    # the root, the empty path, is every directory's ancestor
    every = directories.select("directory", F.explode(F.array_distinct(F.concat(F.array(F.lit("")), ancestors)))
                               .alias("from_dir"))
    near = every.join(given, "from_dir").groupBy("directory").agg(
        F.max(F.struct(F.length("from_dir").alias("depth"), "from_dir", "given")).alias("near"))
    return near.select("directory", F.col("near.from_dir").alias("from_dir"),
                       F.col("near.given.licence").alias("dir_licence"), F.col("near.given.cosine").alias("dir_cosine"))


def scan_licences(docs: DataFrame, path: Column, id_col: str = "doc_id", text_col: str = "text",
                  least: float = SIMILAR) -> DataFrame:
    """doc_id, path, licence, found_in (file, header, inherited, none), cosine
    and from_dir of every file."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    files = docs.select(F.col(id_col).alias("file_id"), row_key(text).alias("key"), path.alias("path"),
                        text.alias("text"))
    own = written(own_licences(files, least), "licences")
    narrow = files.select("file_id", "key", "path")
    directories = narrow.select(directory_of(F.col("path")).alias("directory")).distinct().where(
        F.col("directory").isNotNull())
    up = inherited_licences(directories, own)
    mine = own.select(F.col("file_id").alias("own_id"), F.col("key").alias("own_key"), F.col("path").alias("own_path"),
                      "licence", "cosine")
    joined = narrow.join(mine, (F.col("key") == F.col("own_key")) & same(F.col("file_id"), F.col("own_id"))
                         & same(F.col("path"), F.col("own_path")), "left") \
        .withColumn("directory", directory_of(F.col("path"))).join(up, "directory", "left")
    found = F.when(F.col("licence").isNotNull(), F.when(F.col("path").rlike(_LICENCE_FILE), "file").otherwise("header")) \
        .when(F.col("dir_licence").isNotNull(), "inherited").otherwise("none")
    return joined.select(F.col("file_id").alias("doc_id"), "path",
                         F.coalesce("licence", "dir_licence").alias("licence"), found.alias("found_in"),
                         F.coalesce("cosine", "dir_cosine").alias("cosine"),
                         F.when(F.col("licence").isNull(), F.col("from_dir")).alias("from_dir"))
