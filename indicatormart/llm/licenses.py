"""License scans: MinHash bands over overlapping text windows, verified by exact shingle containment."""

from __future__ import annotations

from collections.abc import Mapping
from importlib import resources

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indicatormart.llm._containment import CONTAINMENT, SHINGLE, banded, document_hits, item_sets, union

#: License notices, short license texts and clauses, as they are commonly written.
#: Licenses that overlap are named by what tells them apart: the third clause of BSD-3-Clause, and in BSD-2-Clause
#: the disclaimer that follows the second clause at once.
_SHORT = {
    "AGPL-3.0-header": (
        "it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, "
        "either version 3 of the License, or (at your option) any later version."),
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at"),
    "BSD-2-Clause": "materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY",
    "BSD-3-Clause": (
        "may be used to endorse or promote products derived from this software without specific prior written "
        "permission."),
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC0-1.0": "has waived all copyright and related or neighboring rights to this work",
    "GPL-2.0-header": (
        "it under the terms of the GNU General Public License as published by the Free Software Foundation; either "
        "version 2 of the License, or (at your option) any later version."),
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version."),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    "LGPL-2.1-header": (
        "it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; "
        "either version 2.1 of the License, or (at your option) any later version."),
    "LGPL-3.0-header": (
        "it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, "
        "either version 3 of the License, or (at your option) any later version."),
    "MIT": "Released under the MIT License.",
    "MIT-permission": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction"),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
        "was not distributed with this file, You can obtain one at"),
    "MIT-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions: The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, "
        "EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR "
        "PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, "
        "DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN "
        "CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
}

#: One-line notices: a verb, a license and the mark that follows.
_VERBS = ("licensed", "released", "distributed", "available", "published", "provided")
_NAMES = {
    "AGPL-3.0": ("GNU Affero General Public License v3.0", "AGPL-3.0 license"),
    "Apache-2.0": ("Apache License 2.0", "Apache 2.0 license", "Apache License, Version 2.0"),
    "BSD-2-Clause": ("BSD 2-Clause License", "2-clause BSD license"),
    "BSD-3-Clause": ("BSD 3-Clause License", "3-clause BSD license"),
    "GPL-2.0": ("GNU General Public License v2.0", "GPL-2.0 license"),
    "GPL-3.0": ("GNU General Public License v3.0", "GPL-3.0 license"),
    "ISC": ("ISC License",),
    "LGPL-2.1": ("GNU Lesser General Public License v2.1", "LGPL-2.1 license"),
    "LGPL-3.0": ("GNU Lesser General Public License v3.0", "LGPL-3.0 license"),
    "MIT": ("MIT License",),
    "MPL-2.0": ("Mozilla Public License 2.0", "MPL-2.0 license"),
}
_MARKS = ("", ".", ",", ";", ":", ")")


def _templates() -> dict[str, str]:
    """Short forms, whole texts (``license_texts``) and one-line notices that no short form is already."""
    out = dict(_SHORT)
    for file in sorted(resources.files("indicatormart.llm").joinpath("license_texts").iterdir(), key=lambda f: f.name):
        out[file.name.removesuffix(".txt") + "-text"] = file.read_text("utf-8")
    known = {" ".join(t.lower().split()) for t in out.values()}
    for name, forms in _NAMES.items():
        lines = [f"{verb} under the {form}{mark}" for form in forms for verb in _VERBS for mark in _MARKS]
        lines = [x for x in lines if x.lower() not in known]
        out |= {f"{name}-notice-{n}": x for n, x in enumerate(lines, 1)}
    return out


TEMPLATES = _templates()


def scan(docs: DataFrame, templates: Mapping[str, str] | None = None, id_col: str = "doc_id", text_col: str = "text",
         shingle: int = SHINGLE, containment: float = CONTAINMENT) -> DataFrame:
    """``(doc_id, text_key, license, start_word, n_windows, n_shared, n_shingles, containment)``.

    One row per document and template found: the first window of the highest
    containment, and the number of windows that hold the template.  Windows
    overlap by half, so every copy of a template lies whole in one.  Null,
    empty and blank texts match nothing; a null ``doc_id`` matches like any
    other; repeated rows (same id and text) give one row; other columns are
    ignored; an empty table or no templates give no rows.
    """
    spark = docs.sparkSession
    known = spark.createDataFrame(sorted((templates if templates is not None else TEMPLATES).items()),
                                  "license string, text string")
    sets = item_sets(known, "license", "text", shingle)
    found = union(document_hits(docs, banded(sets, containment, only_banded=True), id_col, text_col,
                                only_banded=True))
    if found is None:
        return spark.createDataFrame([], "doc_id long, text_key long, license string, start_word long, "
                                         "n_windows long, n_shared long, n_shingles long, containment double")
    windows = found.select("doc_id", "text_key", "set_id", "q", F.explode(F.array("first", "second")).alias("w")).where(
        F.col("w").isNotNull() & (F.col("w.shared") >= F.col("q") * F.lit(containment) - 1e-9)).distinct()
    best = F.max_by("w", F.struct(F.col("w.shared"), -F.col("w.start")))
    per_doc = windows.groupBy("doc_id", "text_key", "set_id", "q").agg(best.alias("w"), F.count("*").alias("n_windows"))
    names = F.broadcast(sets.select("set_id", F.col("item").alias("license")))   # the templates given by the caller
    return per_doc.join(names, "set_id").select(
        "doc_id", "text_key", "license", F.col("w.start").cast("long").alias("start_word"), "n_windows",
        F.col("w.shared").cast("long").alias("n_shared"), F.col("q").cast("long").alias("n_shingles"),
        (F.col("w.shared") / F.col("q")).alias("containment"))
