"""Licences of files: TF-IDF cosine of headers and licence files to templates, then inheritance by folder.

Units are the lines that hold a licence cue, the leading comment block if it holds one, and
the whole text of a licence file. Templates are sentences, full headers and whole licences.
Equal units are compared once, however many files hold them. Weights come from all units of the corpus. A folder takes the licence of
the licence file in it, and a file without a licence of its own that of the nearest folder
above it, found by joining the ancestors of distinct folders.

Built from DataFrame functions only.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loanweave.sources.staging import stage, staged

#: Header sentences of common licences.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0"),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license."),
    ("CC-BY-4.0", "Licensed under the Creative Commons Attribution 4.0 International License, CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
)
_GPL = (
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU {0}General Public License "
    "as published by the Free Software Foundation, either version {1} of the License, or (at your option) any later version. "
    "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
    "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {0}General Public License for more details. "
    "You should have received a copy of the GNU {0}General Public License along with this program. If not, see <https://www.gnu.org/licenses/>."
)
#: Full headers that licences ask for in each file.
HEADERS = (
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. '
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
        'writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, '
        "either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    ),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with "
        "this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ),
    *((name, _GPL.format(kind, version)) for name, kind, version in (
        ("GPL-2.0", "", "2"), ("GPL-3.0", "", "3"), ("LGPL-2.1", "Lesser ", "2.1"), ("LGPL-3.0", "Lesser ", "3"),
    )),
    (
        "BSD-3-Clause",
        "Copyright. All rights reserved. Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    ),
)
#: Whole licences, one file each.
TEXTS = Path(__file__).parent / "licenses"
#: A line with one of these is a licence line.
CUES = r"(?i)licen[cs]e|copyright|spdx|public domain"
LICENSE_FILE = r"(?i)(^|/)(licen[cs]e|copying|unlicense)[^/]*$"
#: The comment at the start of a file: a block, or lines that each begin with a comment mark.
HEADER = (
    r"\A(?:#![^\n]*+\n)?\s*+(/\*(?s:.*?)\*/|<!--(?s:.*?)-->|\"{3}(?s:.*?)\"{3}"
    r"|(?:[ \t]*+(?:#|//|--|;|%|\*|dnl |REM )[^\n]*+(?:\n|\z)|[ \t\r]*+\n)++)"
)
MIN_COSINE = 0.6
#: A file with this share of its characters in licence lines is a licence file.
LICENSE_SHARE = 0.3


def whole_licences() -> list[tuple[str, str]]:
    return [(file.stem, file.read_text(encoding="utf-8")) for file in sorted(TEXTS.glob("*.txt"))]


def templates(spark: SparkSession) -> DataFrame:
    rows = F.array(*[F.struct(F.lit(a).alias("license"), F.lit(b).alias("template")) for a, b in [*TEMPLATES, *HEADERS, *whole_licences()]])
    # staged, else each plan that uses them holds the whole texts, and the driver's memory is small
    return stage(spark.range(1).select(F.inline(rows)), "license-templates")


def terms(text: Column) -> Column:
    """Lower-case runs of letters and digits; inner dots and hyphens belong to them."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"[a-z0-9]+(?:[.-][a-z0-9]+)*"), F.lit(0))


def _key(unit: Column) -> Column:
    return F.sha2(unit, 256)  # units can be whole texts, which need not travel with each term


@contextmanager
def _best(units: DataFrame, patterns: DataFrame, min_cosine: float) -> Iterator[DataFrame]:
    """(id, license, cosine) of the best licence of each distinct ``unit``, while the block runs.

    Every step is written and read back, so that no plan holds another one twice.
    """
    forms = patterns.where("template IS NOT NULL").select(_key(F.col("template")).alias("id"), F.col("template").alias("unit"), "license").distinct()
    with staged(forms, "license-forms") as forms:
        ours = units.select(_key(F.col("unit")).alias("id"), "unit", F.lit(True).alias("ours"))
        both = ours.unionByName(forms.select("id", "unit", F.lit(False).alias("ours")))
        with staged(both.groupBy("id", "unit").agg(F.max("ours").alias("ours")), "license-vectors") as vectors:
            total = vectors.count()
            counted = vectors.select("id", "ours", F.explode(terms(F.col("unit"))).alias("term")).groupBy("id", "ours", "term").count()
            with staged(counted, "license-terms") as counted:
                idf = counted.groupBy("term").agg((F.log(F.lit(total + 1.0) / (F.count("*") + 1)) + 1).alias("idf"))
                raw = counted.join(idf, "term").select("id", "ours", "term", (F.col("count") * F.col("idf")).alias("w"))
                rows = raw.groupBy("id", "ours").agg(F.collect_list(F.struct("term", "w")).alias("row"), F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
                unit_rows = rows.select("id", "ours", "norm", F.inline("row")).select("id", "ours", "term", (F.col("w") / F.col("norm")).alias("weight"))
                with staged(unit_rows, "license-weights") as weights:
                    theirs = weights.join(forms.select("id").distinct(), "id", "left_semi").select(F.col("id").alias("form"), "term", F.col("weight").alias("other"))
                    cosine = weights.where("ours").join(theirs, "term").groupBy("id", "form").agg(F.round(F.sum(F.col("weight") * F.col("other")), 6).alias("cosine"))
                    named = cosine.where(F.col("cosine") >= min_cosine).join(forms.select(F.col("id").alias("form"), "license"), "form")
                    best = named.groupBy("id").agg(F.min(F.struct((-F.col("cosine")).alias("far"), "license")).alias("best"))
                    with staged(best.select("id", "best.license", (-F.col("best.far")).alias("cosine")), "license-best") as best:
                        yield best


def match_units(units: DataFrame, patterns: DataFrame, min_cosine: float = MIN_COSINE) -> DataFrame:
    """Distinct units with their best licence: ``unit``, ``license``, ``cosine`` (six decimals).

    ``units`` has ``unit``; ``patterns`` has ``license`` and ``template``. Ties go to the
    smallest licence name. Document frequencies count distinct units and templates.
    """
    with _best(units, patterns, min_cosine) as best:
        found = units.select("unit").distinct().withColumn("id", _key(F.col("unit"))).join(best, "id")
        return stage(found.select("unit", "license", "cosine"), "license-units")


def _folder(path: Column) -> Column:
    return F.regexp_extract(path, r"(?s)^(.*)/[^/]*$", 1)


def _nearest(folders: DataFrame, licensed: DataFrame) -> DataFrame:
    """For each distinct folder, the licence of the nearest licensed folder at or above it."""
    parts = F.split("folder", "/")
    above = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, 1, i), "/"))
    climbed = folders.select("folder", F.posexplode(above).alias("depth", "ancestor"))
    return (
        climbed.join(licensed.withColumnRenamed("folder", "ancestor"), "ancestor")
        .groupBy("folder")
        .agg(F.max(F.struct("depth", F.col("ancestor").alias("from_folder"), "license")).alias("near"))
        .select("folder", "near.from_folder", F.col("near.license").alias("folder_license"))
    )


def scan(files: DataFrame, patterns: DataFrame | None = None, min_cosine: float = MIN_COSINE) -> DataFrame:
    """``path``, ``own_license``, ``cosine``, ``license``, ``origin`` (own, inherited, none),
    ``from_folder`` for each row of ``files`` (``path``, ``text``).

    A file's own licence is that of its best unit (highest cosine, then smallest name): a line
    with a cue, the leading comment with one, or, of a licence file, the whole text. A
    folder's licence is that of its licence file: one named so, or with at least
    ``LICENSE_SHARE`` of its characters in licence lines; of several, the one with the
    highest cosine, then the smallest path.

    - NULL or empty text: no own licence, but a folder's may be inherited.
    - NULL path: the file lies in the unnamed top folder. Repeated rows give repeated results.
    - No files: no rows. Other columns are not read.
    """
    spark = files.sparkSession
    found = (
        files.select("path", F.coalesce("text", F.lit("")).alias("text"))
        .withColumn("lines", F.filter(F.split("text", "\n"), lambda line: F.rlike(line, F.lit(CUES))))
        .withColumn("unit_chars", F.aggregate("lines", F.lit(0), lambda a, u: a + F.length(u)))
        .withColumn("is_file", F.coalesce(F.rlike("path", F.lit(LICENSE_FILE)), F.lit(False)) | (F.col("unit_chars") >= LICENSE_SHARE * F.length("text")))
    )
    header = F.when(F.size("lines") > 0, F.regexp_extract("text", HEADER, 1))
    units = F.concat(
        "lines",
        F.filter(F.array(header), lambda unit: F.rlike(unit, F.lit(CUES))),
        F.when(F.col("is_file") & (F.trim("text") != ""), F.array("text")).otherwise(F.array().cast("array<string>")),
    )
    base = found.select(
        "path",
        F.coalesce(_folder(F.col("path")), F.lit("")).alias("folder"),
        F.array_sort(F.array_distinct(units)).alias("units"),
        "is_file",
    )
    with staged(base, "license-lines") as base:  # texts are scanned once, their licence lines are few
        # Equal sets of units (mostly one common line) are resolved once.
        base = base.withColumn("key", F.sha2(F.to_json("units"), 256))
        kinds = base.where(F.size("units") > 0).select("key", "units").distinct().select("key", F.explode("units").alias("unit"))
        with (
            staged(kinds, "license-kinds") as kinds,
            _best(kinds.select("unit"), patterns if patterns is not None else templates(spark), min_cosine) as best,
        ):
            resolved = (
                kinds.select("key", _key(F.col("unit")).alias("id"))
                .join(best, "id")
                .groupBy("key")
                .agg(F.min(F.struct((-F.col("cosine")).alias("far"), "license")).alias("top"))
                .select("key", F.col("top.license").alias("own_license"), (-F.col("top.far")).alias("cosine"))
            )
            columns = ["path", "folder", "is_file", "own_license", "cosine"]
            # files without licence lines, mostly the larger part, have nothing to be joined on
            bare = base.where(F.size("units") == 0).select("*", F.lit(None).cast("string").alias("own_license"), F.lit(None).cast("double").alias("cosine"))
            owned = stage(base.where(F.size("units") > 0).join(resolved, "key", "left").select(columns).unionByName(bare.select(columns)), "license-owned")
    licensed = (
        owned.where(F.col("own_license").isNotNull() & F.col("is_file"))
        .groupBy("folder")
        .agg(F.min(F.struct((-F.col("cosine")).alias("far"), F.coalesce("path", F.lit("")).alias("path"), "own_license")).alias("top"))
        .select("folder", F.col("top.own_license").alias("license"))
    )
    near = _nearest(owned.select("folder").distinct(), licensed)
    own = F.col("own_license").isNotNull()
    return owned.join(near, "folder", "left").select(
        "path",
        "own_license",
        "cosine",
        F.coalesce("own_license", "folder_license").alias("license"),
        F.when(own, "own").when(F.col("folder_license").isNotNull(), "inherited").otherwise("none").alias("origin"),
        F.when(~own, F.col("from_folder")).alias("from_folder"),
    )
