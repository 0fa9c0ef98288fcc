"""Licence scan, in DataFrame functions only.

Headers are compared with licence templates by the cosine of sparse TF-IDF vectors. Headers are, where
they hold a licence cue: lines, paragraphs, runs of adjacent comment lines or of adjacent other lines
(so a header that is wrapped over several lines is one), all without comment marks, and the whole
text of licence files. The templates are one-line headers, SPDX identifiers, the paragraphs of usual
file headers, and titles and telling paragraphs of whole licences, by which a licence file of any
length is known. The inverse document frequencies are those of the templates, a word of no template
counting as the rarest. The best template from `least` on is
a file's own licence. A file without one inherits from the licence file of the nearest ancestor
directory, its own directory first: the directories with licence files join the ancestors of the
distinct directories, so a directory is resolved once however many files it holds.

Defined cases: null and empty texts have no licence of their own. A null path has no directory and
inherits nothing; a path without a slash lies in the root directory, which is an ancestor of all.
Several licence files in a directory: the highest cosine counts, then the smaller name. Ties
between templates: the smaller name. Repeated rows each get their result. Texts are used whole;
other columns are ignored.
"""

from __future__ import annotations

import json
import math
from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm.tables import text_of
from ledgerlens.sources.staging import staged

LEAST = 0.6
#: Header forms, paragraphs and titles of common licences. A name may have several.
_FORMS = (
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not "
     "use this file except in compliance with the License. You may obtain a copy of the License"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without "
     "modification, are permitted provided that the following conditions are met"),
    ("BSD-3-Clause", "Released under the BSD License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under the Creative Commons Attribution 4.0 License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("ISC", "Permission to use, copy, modify, and distribute this software for any purpose with "
     "or without fee is hereby granted"),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
     "software and associated documentation files, to deal in the Software without restriction"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, "
     "v. 2.0."),
    ("Proprietary", "All rights reserved."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    # file headers of several lines
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the "
     "terms of the GNU Affero General Public License as published by the Free Software Foundation, "
     "either version 3 of the License, or (at your option) any later version."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not "
     "use this file except in compliance with the License. You may obtain a copy of the License at "
     "http://www.apache.org/licenses/LICENSE-2.0"),
    ("Apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed "
     "under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF "
     "ANY KIND, either express or implied. See the License for the specific language governing "
     "permissions and limitations under the License."),
    ("BSD-3-Clause", "Copyright (c) The Authors. All rights reserved. Use of this source code is "
     "governed by a BSD-style license that can be found in the LICENSE file."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the "
     "terms of the GNU General Public License as published by the Free Software Foundation; "
     "either version 2 of the License, or (at your option) any later version."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the "
     "terms of the GNU General Public License version 2 as published by the Free Software "
     "Foundation."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the "
     "terms of the GNU General Public License as published by the Free Software Foundation, "
     "either version 3 of the License, or (at your option) any later version."),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the "
     "terms of the GNU Lesser General Public License as published by the Free Software "
     "Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("LGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the "
     "terms of the GNU Lesser General Public License as published by the Free Software "
     "Foundation, either version 3 of the License, or (at your option) any later version."),
    ("MIT", "Use of this source code is governed by an MIT-style license that can be found in the "
     "LICENSE file or at https://opensource.org/licenses/MIT."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, "
     "v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at "
     "https://mozilla.org/MPL/2.0/."),
    ("Proprietary", "Copyright (c). All rights reserved."),
    # titles and telling paragraphs of whole licences
    ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"),
    ("BSD-3-Clause", "Neither the name of the copyright holder nor the names of its contributors may "
     "be used to endorse or promote products derived from this software without specific prior "
     "written permission."),
    ("CC-BY-4.0", "Creative Commons Attribution 4.0 International Public License"),
    ("CC-BY-NC-4.0", "Creative Commons Attribution-NonCommercial 4.0 International Public License"),
    ("CC-BY-SA-4.0", "Creative Commons Attribution-ShareAlike 4.0 International Public License"),
    ("CC0-1.0", "Creative Commons Legal Code CC0 1.0 Universal"),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with "
     "or without fee is hereby granted, provided that the above copyright notice and this "
     "permission notice appear in all copies."),
    ("LGPL-2.1", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999"),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
     "software and associated documentation files (the \"Software\"), to deal in the Software "
     "without restriction, including without limitation the rights to use, copy, modify, merge, "
     "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons "
     "to whom the Software is furnished to do so, subject to the following conditions:"),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    ("Unlicense", "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this "
     "software, either in source code form or as a compiled binary, for any purpose, commercial "
     "or non-commercial, and by any means. In jurisdictions that recognize copyright laws, "
     "the author dedicates any and all copyright interest in the software to the public domain."),
)
#: Identifiers of the licences above, with those that mean the same licence.
_IDENTIFIERS = {
    "AGPL-3.0": ("AGPL-3.0", "AGPL-3.0-only", "AGPL-3.0-or-later"),
    "Apache-2.0": ("Apache-2.0",),
    "BSD-3-Clause": ("BSD-3-Clause",),
    "CC-BY-4.0": ("CC-BY-4.0",),
    "CC-BY-NC-4.0": ("CC-BY-NC-4.0",),
    "CC-BY-SA-4.0": ("CC-BY-SA-4.0",),
    "CC0-1.0": ("CC0-1.0",),
    "GPL-2.0": ("GPL-2.0", "GPL-2.0-only", "GPL-2.0-or-later"),
    "GPL-3.0": ("GPL-3.0", "GPL-3.0-only", "GPL-3.0-or-later"),
    "ISC": ("ISC",),
    "LGPL-2.1": ("LGPL-2.1", "LGPL-2.1-only", "LGPL-2.1-or-later"),
    "LGPL-3.0": ("LGPL-3.0", "LGPL-3.0-only", "LGPL-3.0-or-later"),
    "MIT": ("MIT",),
    "MPL-2.0": ("MPL-2.0",),
    "Unlicense": ("Unlicense",),
}
TEMPLATES = _FORMS + tuple((name, f"SPDX-License-Identifier: {identifier}")
                           for name, known in _IDENTIFIERS.items() for identifier in known)
#: Every template has one of these, so a line without any cannot be a header.
CUE = (r"(?i)licen[cs]e|rights reserved|public domain|\bcc0?\b|hereby granted|redistribution|"
       r"copyright|spdx|mozilla|endorse|creative commons")
#: What comment lines begin with, and everything before their words.
_MARK = r"(?:<!--|/\*|\*|//|#|--|;|%)"
_FRONT = r"(?m)^(?:[ \t]|<!--|-->|/\*+|\*+/?|//+|#+|--+|;+|%+)*+"
LICENCE_FILE = r"(?i)(^|/)(licen[cs]e|copying|notice|copyright)(\.[a-z0-9]+)?$"
_WORD = r"[a-z0-9]+(?:\.[0-9]+)*"


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(_WORD), F.lit(0))


def _words(text: str) -> list[str]:
    import re

    return re.findall(_WORD, text.lower())


def vectors(templates: tuple[tuple[str, str], ...]):
    """Inverse document frequencies, that of other words, and the templates' unit vectors."""
    counts = [Counter(_words(text)) for _, text in templates]
    df = Counter(word for count in counts for word in count)
    idf = {w: math.log((1 + len(templates)) / (1 + n)) + 1 for w, n in df.items()}
    rare = math.log(1 + len(templates)) + 1
    out = []
    for (name, _), count in zip(templates, counts, strict=True):
        weights = {w: n * idf[w] for w, n in count.items()}
        norm = math.sqrt(sum(x * x for x in weights.values())) or 1.0
        out.append((name, {w: x / norm for w, x in sorted(weights.items())}))
    return idf, rare, out


def _constant(spark: SparkSession, rows: list[tuple], columns: str) -> DataFrame:
    """A small table of literals."""
    names = [column.split(":")[0] for column in columns.split(", ")]
    text = json.dumps([dict(zip(names, row, strict=True)) for row in rows])
    return spark.range(1).select(
        F.inline(F.from_json(F.lit(text), f"array<struct<{columns}>>")))


def matched(headers: DataFrame, templates: tuple[tuple[str, str], ...] = TEMPLATES) -> DataFrame:
    """(rid, number, header) -> (rid, licence, cosine) for every licence that shares a word with
    one of the row's headers, with its best cosine. The templates are a constant: a broadcast."""
    spark = headers.sparkSession
    idf, rare, units = vectors(templates)
    known = _constant(spark, sorted(idf.items()), "word:string, idf:double")
    weights = _constant(spark, [(w, i, name, x) for i, (name, unit) in enumerate(units)
                                for w, x in unit.items()],
                        "word:string, template:int, licence:string, weight:double")
    words = (
        headers.select("rid", "number", F.explode(tokens(F.col("header"))).alias("word"))
        .groupBy("rid", "number", "word").agg(F.count("*").alias("n"))
        .join(F.broadcast(known), "word", "left")
        .select("rid", "number", "word",
                (F.col("n") * F.coalesce("idf", F.lit(rare))).alias("x")))
    words = staged(words, "words")
    norms = words.groupBy("rid", "number").agg(
        F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("norm"))
    dots = (words.join(F.broadcast(weights), "word")
            .groupBy("rid", "number", "template", "licence")
            .agg(F.sum(F.col("x") * F.col("weight")).alias("dot")))
    return (dots.join(norms, ["rid", "number"])
            .groupBy("rid", "licence")
            .agg(F.max(F.round(F.col("dot") / F.col("norm"), 9)).alias("cosine")))


def headers(text: Column, cue: str = CUE) -> Column:
    """Lines, paragraphs and runs of lines with a cue, without comment marks."""
    text = F.regexp_replace(text, r"\r\n|\r", "\n")
    apart = F.regexp_replace(  # a blank line wherever comment lines begin or end
        F.regexp_replace(text, rf"(?md)^([ \t]*+{_MARK}[^\n]*+)\n(?![ \t]*+{_MARK})", "$1\n\n"),
        rf"(?md)^(?![ \t]*+{_MARK})([^\n]*+)\n(?=[ \t]*+{_MARK})", "$1\n\n")

    def parts(whole: Column, between: str) -> Column:
        bare = F.regexp_replace(whole, _FRONT.replace("(?m)", "(?md)"), "")
        found = F.filter(F.split(bare, between, -1), lambda part: part.rlike(cue))
        return F.transform(found, lambda part: F.btrim(part, F.lit("\n")))

    return F.array_distinct(F.concat(
        parts(text, "\n"), parts(text, "\n{2,}"), parts(apart, "\n{2,}")))


def own_licences(files: DataFrame, least: float = LEAST, cue: str = CUE,
                 templates: tuple[tuple[str, str], ...] = TEMPLATES) -> DataFrame:
    """(rid, key, path, licence, cosine, is_file) of files (key, path, text)."""
    text = text_of()
    is_file = F.coalesce(F.col("path").rlike(LICENCE_FILE), F.lit(False))
    none = F.array().cast("array<string>")
    rows = files.select(
        F.monotonically_increasing_id().alias("rid"), "key", "path", is_file.alias("is_file"),
        F.concat(F.when(text.rlike(cue), headers(text, cue)).otherwise(none),
                 F.when(is_file, F.array(text)).otherwise(none)).alias("headers"))
    # each row keeps its headers only; they are few, so the matching has rows of even size
    rows = staged(rows, "headers")
    best = (
        matched(rows.select("rid", F.posexplode(F.array_distinct("headers"))
                            .alias("number", "header")), templates)
        .where(F.col("cosine") >= least)
        .groupBy("rid").agg(F.min(F.struct((-F.col("cosine")).alias("order"), "licence", "cosine"))
                            .alias("best"))
        .select("rid", "best.licence", "best.cosine"))
    return rows.drop("headers").join(best, "rid", "left")


def directory(path: Column) -> Column:
    """Everything before the last slash; '' for the root; null for a null path."""
    return F.regexp_replace(F.regexp_extract(path, r"^(.*)/[^/]*$", 1), "/+$", "")


def licences(files: DataFrame, key: str, path: str = "path", text: str = "text",
             least: float = LEAST,
             templates: tuple[tuple[str, str], ...] = TEMPLATES) -> DataFrame:
    """One row per file: key, path, licence, origin (own, inherited, none), cosine and, if it is
    inherited, the directory it comes from."""
    rows = files.select(F.col(key).alias("key"), F.col(path).alias("path"),
                        F.col(text).alias("text"))
    found = staged(own_licences(rows, least, templates=templates).withColumn(
        "dir", directory(F.col("path"))), "own")
    licensed = (
        found.where(F.col("is_file") & F.col("licence").isNotNull())
        .groupBy(F.col("dir").alias("from_dir"))
        .agg(F.min(F.struct((-F.col("cosine")).alias("order"), F.col("licence").alias("licence"),
                            F.col("cosine").alias("cosine"))).alias("best"))
        .select("from_dir", "best.licence", "best.cosine"))
    wanting = found.where(F.col("licence").isNull() & F.col("dir").isNotNull())
    parts = F.split("dir", "/")
    depth = F.when(F.col("dir") == "", F.lit(0)).otherwise(F.size(parts))
    ancestors = (
        wanting.select("dir").distinct()
        .select("dir", F.explode(F.sequence(F.lit(0), depth)).alias("depth"))
        .select("dir", "depth", F.when(F.col("depth") == 0, F.lit("")).otherwise(
            F.array_join(F.slice(parts, F.lit(1), F.col("depth")), "/")).alias("from_dir")))
    nearest = staged(
        ancestors.join(licensed, "from_dir")
        .groupBy("dir").agg(F.max(F.struct("depth", "from_dir", "licence", "cosine")).alias("b"))
        .select("dir", F.col("b.from_dir").alias("up_dir"), F.col("b.licence").alias("up_licence"),
                F.col("b.cosine").alias("up_cosine")), "nearest")
    out = found.join(nearest, "dir", "left")
    own = F.col("licence").isNotNull()
    return out.select(
        F.col("key").alias(key), "path", F.coalesce("licence", "up_licence").alias("licence"),
        F.when(own, "own").when(F.col("up_licence").isNotNull(), "inherited").otherwise("none")
        .alias("origin"),
        F.when(own, F.col("cosine")).otherwise(F.col("up_cosine")).alias("cosine"),
        F.when(~own, F.col("up_dir")).alias("from_dir"))
