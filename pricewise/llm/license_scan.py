"""License scans: a trained classifier of word windows confirmed by template comparison.

Units of text become sparse hashed word 1- and 2-grams; a multinomial logistic
regression tells license families, license talk of no known family (``unknown``) and
other text (``none``) apart. Units are the lines and, in paragraphs (lines up to one without
words) that hold a word of ANCHORS, overlapping windows of SIZES words, so that notices
inside longer lines and notices wrapped over lines are units too. The regression is trained on
variants of the notices and standard paragraphs below, bare and inside prose, against
lines of the corpus and parts of them (a bounded sample, ``NEGATIVE_DOCS`` and
``NEGATIVE_ROWS``). Held-out rows calibrate it: a temperature for its probabilities and the
probability below which a family becomes ``unknown``. A unit that the regression
calls a license must also hold enough words of a template; the template that fits best
gives the family, else it is ``unknown``. DataFrame functions and Spark ML only.
"""

from __future__ import annotations

import json
import math
import random

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF, NGram
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pricewise.llm.common import stored

# Notices of public licenses, by family.
TEMPLATES = {
    "apache": ["Licensed under the Apache License, Version 2.0.", "SPDX-License-Identifier: Apache-2.0",
               "You may not use this file except in compliance with the Apache License.",
               "Distributed under the Apache License 2.0."],
    "bsd": ["Redistribution and use in source and binary forms, with or without modification, are permitted.",
            "Released under the BSD 3-Clause License.", "SPDX-License-Identifier: BSD-3-Clause",
            "Licensed under the 2-Clause BSD License."],
    "cc0": ["Dedicated to the public domain under CC0 1.0.", "SPDX-License-Identifier: CC0-1.0",
            "This work has been released into the public domain.",
            "To the extent possible under law, the author has waived all copyright."],
    "cc-by": ["Licensed under CC BY 4.0.", "This work is licensed under the Creative Commons Attribution 4.0 International License.",
              "SPDX-License-Identifier: CC-BY-4.0", "Text available under CC BY 3.0."],
    "cc-by-nc": ["Licensed under CC BY-NC 4.0.", "SPDX-License-Identifier: CC-BY-NC-4.0",
                 "This work is licensed under the Creative Commons Attribution-NonCommercial 4.0 License.",
                 "Available under CC BY-NC 3.0 for noncommercial use."],
    "cc-by-sa": ["Licensed under CC BY-SA 4.0.", "SPDX-License-Identifier: CC-BY-SA-4.0",
                 "This work is licensed under the Creative Commons Attribution-ShareAlike 4.0 License.",
                 "Text is available under the CC BY-SA 3.0 license."],
    "gpl": ["This work is licensed under the GNU General Public License, version 3.", "SPDX-License-Identifier: GPL-3.0-only",
            "You can redistribute it and/or modify it under the terms of the GNU General Public License.",
            "Released under the GPL version 2 or later."],
    "agpl": ["Licensed under the GNU Affero General Public License, version 3.", "SPDX-License-Identifier: AGPL-3.0-only",
             "Released under the terms of the AGPL."],
    "lgpl": ["Licensed under the GNU Lesser General Public License, version 2.1.", "SPDX-License-Identifier: LGPL-2.1-only",
             "Released under the terms of the LGPL."],
    "mit": ["Released under the MIT License.", "Licensed under the MIT license.", "SPDX-License-Identifier: MIT",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software."],
    "mpl": ["Subject to the terms of the Mozilla Public License, version 2.0.", "SPDX-License-Identifier: MPL-2.0",
            "Licensed under the MPL 2.0."],
    "proprietary": ["All rights reserved.", "Copyright, all rights reserved.",
                    "Proprietary and confidential, unauthorized copying of this file is prohibited."],
    "unknown": ["Licensed under the terms of the agreement that accompanies it.", "See the LICENSE file for license terms.",
                "Use of this work is subject to a license.", "This content is licensed, see its license for details.",
                "Released under its own license, version 1.", "Distributed under a custom license."],
}
_GNU = ("This {0} is free software: you can redistribute it and/or modify it under the terms of the GNU {1} as published by "
        "the Free Software Foundation, either version {2} of the License, or (at your option) any later version.",
        "This {0} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied "
        "warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {1} for more details.",
        "You should have received a copy of the GNU {1} along with this {0}. If not, see <https://www.gnu.org/licenses/>.")
_CC = ("This work is licensed under the Creative Commons {0} 4.0 International License. To view a copy of this license, visit "
       "http://creativecommons.org/licenses/{1}/4.0/ or send a letter to Creative Commons, PO Box 1866, Mountain View, CA 94042, USA.",
       "You are free to share and adapt the material under the terms of the Creative Commons {0} license ({2}).",
       "This is an open access article distributed under the terms of the Creative Commons {0} License ({2} 4.0).")
# The standard paragraphs of the license texts and headers, by family.
PARAGRAPHS = {
    "apache": ['Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the '
               "License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
               'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an '
               '"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the '
               "specific language governing permissions and limitations under the License."],
    "bsd": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
            "following conditions are met:",
            "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
            "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following "
            "disclaimer in the documentation and/or other materials provided with the distribution.",
            "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
            "derived from this software without specific prior written permission.",
            'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, '
            "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
            "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
            "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
            "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
            "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE "
            "OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."],
    "cc0": ["To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to this "
            "software to the public domain worldwide. This software is distributed without any warranty.",
            "You should have received a copy of the CC0 Public Domain Dedication along with this software. If not, see "
            "<http://creativecommons.org/publicdomain/zero/1.0/>.",
            "The person who associated a work with this deed has dedicated the work to the public domain by waiving all of his or her "
            "rights to the work worldwide under copyright law, including all related and neighboring rights, to the extent allowed by law."],
    "cc-by": [t.format("Attribution", "by", "CC BY") for t in _CC],
    "cc-by-nc": [t.format("Attribution-NonCommercial", "by-nc", "CC BY-NC") for t in _CC],
    "cc-by-sa": [t.format("Attribution-ShareAlike", "by-sa", "CC BY-SA") for t in _CC],
    "gpl": [t.format("program", "General Public License", v) for v in "32" for t in _GNU],
    "agpl": [t.format("program", "Affero General Public License", 3) for t in _GNU],
    "lgpl": [t.format("library", "Lesser General Public License", v) for v in ("2.1", "3") for t in _GNU],
    "mit": ['Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation '
            'files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, '
            "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
            "Software is furnished to do so, subject to the following conditions:",
            "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
            'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE '
            "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR "
            "COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
            "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."],
    "mpl": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
            "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
            'This Source Code Form is "Incompatible With Secondary Licenses", as defined by the Mozilla Public License, v. 2.0.'],
    "proprietary": ["All rights reserved. No part of this publication may be reproduced, distributed, or transmitted in any form or by any "
                    "means, including photocopying, recording, or other electronic or mechanical methods, without the prior written "
                    "permission of the publisher.",
                    "This document contains proprietary and confidential information and may not be copied or disclosed without the "
                    "prior written permission of its owner."],
}
# Function words; every other word of a template is an anchor (a confirmed unit holds at least one, see ANCHORS).
ORDINARY = set("""a above an and any are as at be been but by can do for from has have he her his if in into is it its may more must no
    not of on one only or out s should so such that the their this to under was who will with you""".split())
SIZES = [8, 16, 32, 64, 128, 256]  # words of a window; windows start every half size, so a run of up to half + 1 words lies in one
OPENINGS = ["", "this file is", "copyright 2020 the authors", "notice"]
NEGATIVE_DOCS = 1_000
NEGATIVE_ROWS = 6_000
FEATURES = 1 << 14
CONFIRMED = 0.7  # share of a template's words that a unit must hold
EMBEDDED = 6  # training windows of prose around every notice
ACCEPTED = 0.95  # share of right held-out family predictions that the calibrated probability lets pass


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")


def _literal(spark: SparkSession, rows: list[dict], schema: str) -> DataFrame:
    return spark.range(1).select(F.explode(F.from_json(F.lit(json.dumps(rows)), f"array<struct<{schema}>>")).alias("r")).select("r.*")


def _plain(notice: str) -> list[str]:
    return "".join(c.lower() if c.isalnum() else " " for c in notice).split()


def notices() -> list[tuple[str, str]]:
    """(family, text) of all templates."""
    return [(f, t) for of in (TEMPLATES, PARAGRAPHS) for f, ts in of.items() for t in ts]


def size_of(n: int) -> int:
    """The smallest window size of which some window holds a run of ``n`` words, wherever it begins."""
    return next(s for s in SIZES if n <= s // 2 + 1)


# No unit without one of these holds CONFIRMED of a template's words (tested).
ANCHORS = sorted({w for f, t in notices() for w in _plain(t)} - ORDINARY)


def _gate(notice: str) -> list[str]:
    """Words of which any unit that holds CONFIRMED of the notice's has one: so many that too few
    are left without them, the rarest by length."""
    own = sorted(set(_plain(notice)), key=lambda w: (w in ORDINARY, -len(w), w))
    return own[:len(own) - math.ceil(CONFIRMED * len(own) - 1e-9) + 1]


# A window without one of these can hold no template: it is not cut at all.
GATE = sorted({w for _, t in notices() for w in _gate(t)})

KNOWN = [(f, size_of(len(_plain(t))), sorted(set(_plain(t)))) for f, t in notices() if f != "unknown"]  # those that can confirm


def _known() -> tuple[Column, Column]:
    """The templates that can confirm, as literals: structs (i, family, size, words) and their words alone."""
    rows = [{"i": i, "family": f, "size": s, "words": w} for i, (f, s, w) in enumerate(KNOWN)]
    return (F.from_json(F.lit(json.dumps(rows)), "array<struct<i:int,family:string,size:int,words:array<string>>>"),
            F.from_json(F.lit(json.dumps([w for *_, w in KNOWN])), "array<array<string>>"))


def training_rows(spark: SparkSession, prose: list[list[str]]) -> DataFrame:
    """Variants of every notice: openings, without its first or last word, and inside windows of
    ``prose`` as the scan cuts them."""
    rng = random.Random(0)
    rows = []
    for family, notice in notices():
        w = notice.split(" ")
        for body in {notice, " ".join(w[1:]), " ".join(w[:-1])} if len(w) > 4 else {notice}:
            rows += [{"family": family, "para": f"{o} {body}".strip()} for o in OPENINGS]
        for _ in range(EMBEDDED if prose else 0):
            free = rng.randint(1, max(1, size_of(len(_plain(notice))) - len(_plain(notice))))
            around = [x for _ in range(64) for x in rng.choice(prose)][:free]
            before = rng.randint(0, len(around))
            rows.append({"family": family, "para": " ".join([*around[:before], notice, *around[before:]])})
    return _literal(spark, rows, "family:string,para:string")


def units(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(_id, _row, line, at, size, whole, _w): the words of all lines (``line``) and of the windows of paragraphs.

    ``at`` is the place of the first and last word: line number x 2^31 + number in the line. ``whole``:
    nothing of the line or paragraph lies outside. A null or empty text has one line without words.
    """
    base = docs.select(F.col(id_col).alias("_id"), F.monotonically_increasing_id().alias("_row"),
                       F.transform(F.split(F.coalesce(F.col(text_col), F.lit("")), "\n"), words).alias("_lw"))
    gate = F.array(*[F.lit(x) for x in GATE])

    def place(no, i):
        return F.shiftleft(no.cast("long"), 31) + i

    def unit(line, first, last, size, whole, at, w):
        return F.struct(line.alias("line"), first.alias("first"), last.alias("last"), size.cast("int").alias("size"),
                        whole.alias("whole"), at.alias("at"), w.alias("w"))

    def fitting(n):
        # a longer line is compared in windows alone: its words lie strewn
        return F.coalesce(*[F.when(n <= s, F.lit(s)) for s in SIZES], F.lit(4 * SIZES[-1]))

    none = F.array().cast("array<bigint>")
    lines = F.transform("_lw", lambda w, no: unit(F.lit(True), place(no, F.lit(0)), place(no, F.size(w) - 1), fitting(F.size(w)),
                                                  F.lit(True), none, w))
    # paragraphs: words joined by spaces, lines by line feeds, so an empty line parts them; each line begins with its number
    marked = F.array_join(F.transform("_lw", lambda w, no: F.when(F.size(w) > 0, F.concat_ws(" ", no.cast("string"), F.array_join(w, " ")))
                                      .otherwise("")), "\n")

    def numbered(text):
        # bound once: a reference inside the inner function would split the line for every word
        return F.transform(F.array(F.split(text, " ")), lambda parts: F.transform(
            F.slice(parts, 2, F.size(parts) - 1), lambda w, i: F.struct(
                place(parts[0].cast("int"), i).alias("at"), w.alias("w"))))[0]

    def windows(p):
        n = F.size(p)

        def of(size):
            half = size // 2
            starts = F.when((n > half) | F.lit(size == SIZES[0]), F.sequence(F.lit(0), F.greatest(n - half - 1, F.lit(0)), F.lit(half)))
            return F.coalesce(F.transform(starts, lambda b: _cut(p, b, size)), F.array())

        def _cut(p, b, size):
            part = F.slice(p, b + 1, size)
            return unit(F.lit(False), part[0]["at"], F.element_at(part, -1)["at"], F.lit(size), n <= size, part["at"], part["w"])
        return F.filter(F.concat(*[of(s) for s in SIZES]), lambda u: F.arrays_overlap(u["w"], gate))

    paras = F.transform(F.filter(F.split(marked, "\n{2,}"), lambda t: F.arrays_overlap(F.split(t, "[ \n]"), gate)),
                        lambda t: F.flatten(F.transform(F.filter(F.split(t, "\n"), lambda x: x != ""), numbered)))
    base = base.withColumn("_p", F.when(F.exists("_lw", lambda w: F.arrays_overlap(w, gate)), paras).otherwise(F.array()))
    every = F.concat(lines, F.flatten(F.transform("_p", windows)))
    return base.select("_id", "_row", F.explode(every).alias("_u")).select("_id", "_row", "_u.*").withColumnRenamed("w", "_w")


def featurise(df: DataFrame) -> DataFrame:
    df = NGram(n=2, inputCol="_w", outputCol="_w2").transform(df)
    df = df.withColumn("_grams", F.concat("_w", "_w2"))
    return HashingTF(numFeatures=FEATURES, binary=True, inputCol="_grams", outputCol="features").transform(df)


class LicenseModel:
    """The fitted regression with its class names, temperature and least family probability."""

    def __init__(self, model: LogisticRegressionModel, classes: list[str], temperature: float, least: float):
        self.model, self.classes, self.temperature, self.least = model, classes, temperature, least


def train(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", max_iter: int = 40) -> LicenseModel:
    """Fit and calibrate. Sampled corpus paragraphs that resemble a template are left out of
    the negatives."""
    spark = docs.sparkSession
    chosen = (docs.select(F.col(id_col).alias("_c")).where("_c is not null").distinct()
              .orderBy(F.xxhash64(F.lit("license"), "_c"), "_c").limit(NEGATIVE_DOCS))
    negatives = (docs.join(F.broadcast(chosen), docs[id_col] == F.col("_c"), "left_semi")
                 .select(F.explode(F.split(F.coalesce(F.col(text_col), F.lit("")), "\n")).alias("para"))
                 .where(F.length("para") > 0).select("para").distinct()
                 .orderBy(F.xxhash64(F.lit("license"), "para"), "para").limit(NEGATIVE_ROWS))
    tables = F.array(*[F.array(*[F.lit(w) for w in sorted(set(_plain(t)))]) for _, t in notices()])
    w = F.array_distinct(words(F.col("para")))
    negatives = negatives.where(~F.exists(tables, lambda t: F.size(F.array_intersect(w, t)) >= 0.6 * F.size(t)))
    negatives = stored(negatives.coalesce(2), "license-negatives")
    own = words(F.col("para"))
    prose = [r[0] for r in negatives.select(F.slice(own, 1, SIZES[-1]).alias("w")).where("size(w) > 2")
             .orderBy(F.xxhash64(F.lit("prose"), "w")).limit(300).collect()]
    # parts of the sizes that the scan scores, too
    size = F.element_at(F.array(*[F.lit(s) for s in SIZES]), F.pmod(F.xxhash64(F.lit("size"), "para"), F.lit(len(SIZES))).cast("int") + 1)
    begin = F.pmod(F.xxhash64(F.lit("begin"), "para"), F.greatest(F.size(own) - size, F.lit(0)) + 1).cast("int") + 1
    parts = negatives.where(F.size(own) > size).select(F.array_join(F.slice(own, begin, size), " ").alias("para"))
    rows = training_rows(spark, prose).unionByName(negatives.union(parts).select(F.lit("none").alias("family"), "para"))
    classes = sorted([*TEMPLATES, "none"])
    label = F.array_position(F.array(*[F.lit(c) for c in classes]), F.col("family")).cast("double") - 1
    rows = stored(rows.select("family", "para", label.alias("label"),
                              (F.pmod(F.xxhash64(F.lit("held"), "para"), F.lit(5)) == 0).alias("held")).coalesce(2), "license-train")
    many = {r["family"]: r["count"] for r in rows.where("not held").groupBy("family").count().collect()}
    weight = F.create_map(*[F.lit(x) for c, n in many.items() for x in (c, 1000.0 / n * (4.0 if c == "none" else 1.0))])
    data = featurise(rows.withColumn("_w", words(F.col("para")))).withColumn("weight", weight[F.col("family")])
    fitted = LogisticRegression(maxIter=max_iter, regParam=1e-3, family="multinomial", weightCol="weight").fit(
        data.where("not held").select("features", "label", "weight"))
    held = (fitted.transform(data.where("held").select("features", "label"))
            .select("label", vector_to_array("rawPrediction").alias("raw")).collect())
    temperature = min((t / 10 for t in range(2, 51)), key=lambda t: sum(-_log_softmax(r["raw"], t)[int(r["label"])] for r in held))
    plain = {classes.index("none"), classes.index("unknown")}
    right = sorted(math.exp(max(_log_softmax(r["raw"], temperature))) for r in held
                   if int(r["label"]) not in plain and max(range(len(classes)), key=r["raw"].__getitem__) == int(r["label"]))
    least = right[int((1 - ACCEPTED) * len(right))] if right else 0.5
    return LicenseModel(fitted, classes, temperature, min(least, 0.9))


def _log_softmax(raw: list[float], t: float) -> list[float]:
    top = max(raw)
    total = math.log(sum(math.exp((x - top) / t) for x in raw))
    return [(x - top) / t - total for x in raw]


def license_paragraphs(docs: DataFrame, model: LicenseModel, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Lines that hold a license: (_id, _no, family, probability, likeness, confirmed), one row per line and family.

    A notice counts at the line with most of its words. ``probability`` is the calibrated one of
    any license, ``likeness`` the share of the best template's words over CONFIRMED. ``family`` is
    ``unknown`` (``confirmed`` false) where the probability is too low or no template is
    held; lines with a part of a confirmed notice are not ``unknown``. Of overlapping notices
    that share their telling words the one that fits its template best stays.
    """
    scored = model.model.transform(featurise(units(docs, id_col, text_col)))
    none = model.classes.index("none")
    # the few units the regression keeps are written first: what follows refers to them many times
    scored = stored(scored.where((F.col("prediction") != none) & (F.size("_w") > 0))
                    .select("_id", "_row", "line", "first", "last", "size", "whole", "at", "_w",
                            vector_to_array("rawPrediction").alias("_raw")), "license-units")
    odds = F.transform("_raw", lambda x: F.exp((x - F.array_max("_raw")) / model.temperature))
    scored = scored.withColumn("probability", 1 - odds[none] / F.aggregate(odds, F.lit(0.0), lambda a, x: a + x))
    own = F.array_distinct("_w")
    # a window is compared with the templates of its size, a whole line or paragraph also with longer ones
    known, template = _known()
    fit = F.filter(known, lambda t: (t["size"] == F.col("size")) | (F.col("whole") & (2 * t["size"] >= F.col("size"))))
    match = F.transform(fit, lambda t: F.struct(F.size(F.array_intersect(own, t["words"])).alias("n"), t.alias("t")))
    # words held less words missing: of two templates that share words the one that fits
    share = F.transform(match, lambda m: F.struct(
        (m["n"] / F.size(m["t"]["words"]) >= CONFIRMED).alias("holds"), (2 * m["n"] - F.size(m["t"]["words"])).alias("n"),
        (m["n"] / F.size(m["t"]["words"])).alias("share"), m["t"]["family"].alias("family"), m["t"]["i"].alias("i")))
    scored = scored.withColumn("_m", F.array_max(share))
    sure = F.coalesce(F.col("_m.holds"), F.lit(False)) & (F.col("probability") >= model.least)
    scored = (scored.withColumn("confirmed", sure).withColumn("likeness", F.coalesce(F.col("_m.share") / CONFIRMED, F.lit(0.0)))
              .where(F.col("confirmed") | F.col("line") | (F.col("probability") >= model.least)))
    anchors = F.array(*[F.lit(x) for x in ANCHORS])
    telling = F.when(F.col("confirmed"), F.get(template, F.col("_m.i"))).otherwise(anchors)
    held = F.filter(F.transform(F.arrays_zip("at", "_w"), lambda x: F.when(
        F.array_contains(telling, x["_w"]), F.shiftright(x["at"], 31))), lambda x: x.isNotNull())
    best = F.array_max(F.transform(F.array_distinct(held), lambda no: F.struct(
        F.size(F.filter(held, lambda x: x == no)).alias("n"), (-no).alias("no"))))
    scored = scored.select("_id", "_row", "line", "first", "last", "confirmed", "probability", "likeness", "_m.n", "_m.family", "_m.i",
                           (-F.size("_w")).alias("tight"), F.array_intersect(F.array_intersect(own, telling), anchors).alias("_told"),
                           F.when(F.col("line"), F.shiftright("first", 31)).otherwise(-best["no"]).cast("int").alias("_no"))
    # all confirmed units of the text: few, and never more than a row's text has
    near = Window.partitionBy("_row")
    entry = F.struct("first", "last", "n", "likeness", "tight", "i")

    def beaten(others):
        """An overlapping notice fits better and its template has all the telling words found here."""
        return F.exists(others, lambda o: (o["first"] <= F.col("last")) & (o["last"] >= F.col("first")) & F.when(
            F.col("confirmed"), (F.struct(o["n"], o["likeness"], o["tight"], -o["first"]) > F.struct("n", "likeness", "tight", -F.col("first")))
            & (F.size(F.array_except("_told", F.get(template, o["i"]))) == 0)).otherwise(True))
    scored = scored.withColumn("_near", F.collect_list(F.when(F.col("confirmed"), entry)).over(near))
    scored = scored.withColumn("_best", F.col("confirmed") & ~beaten(F.col("_near"))).drop("_near")
    scored = scored.withColumn("_near", F.collect_list(F.when(F.col("_best"), entry)).over(near))
    kept = scored.where(~beaten(F.col("_near")))
    family = F.when(F.col("confirmed"), F.col("family")).otherwise("unknown")
    kept = kept.groupBy("_id", "_row", "_no", family.alias("family")).agg(F.max("probability").alias("probability"),
                                                                          F.max("likeness").alias("likeness"))
    return kept.select("_id", "_no", "family", "probability", "likeness", (F.col("family") != "unknown").alias("confirmed"))


def scan_licenses(docs: DataFrame, model: LicenseModel | None = None, *, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """One row per id: n_paragraphs (lines), n_licenses (confirmed, per line and family), n_unknown,
    families (sorted, comma-joined).

    Rows that share an id, repeated ones too, are one document; rows without an id are one
    together. Null and empty texts have one paragraph and no license. An empty
    table gives no rows (the classifier then learns from the notices alone).
    """
    model = model or train(docs, id_col=id_col, text_col=text_col)
    lines = docs.select(F.col(id_col).alias("_id"), F.size(F.split(F.coalesce(F.col(text_col), F.lit("")), "\n")).cast("long").alias("_n"),
                        F.lit(None).cast("string").alias("family"))
    found = license_paragraphs(docs, model, id_col=id_col, text_col=text_col).select("_id", F.lit(0).cast("long").alias("_n"), "family")
    known = F.col("family") != "unknown"
    return lines.unionByName(found).groupBy(F.col("_id").alias(id_col)).agg(
        F.sum("_n").alias("n_paragraphs"), F.count_if(known).alias("n_licenses"),
        F.count_if(F.col("family") == "unknown").alias("n_unknown"),
        F.array_join(F.array_sort(F.collect_set(F.when(known, F.col("family")))), ",").alias("families"))
