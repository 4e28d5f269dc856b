"""License scans by diagonal voting, in DataFrame operations only.

Every k-gram of words of every text is hashed and joined to the positions of the same k-gram in license templates.
A hit at word p of a text and word t of a template votes for the diagonal p - t of that text and template. Votes are
counted by diagonal, neighbouring diagonals (words put in or left out) are merged, and a merged span is verified:
the words of each hit are compared, the distinct template places that were hit must cover enough of the template, and
the span may not be much longer than the template.
"""

from __future__ import annotations

from collections.abc import Sequence
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

K = 4
#: Diagonals at most so far apart are merged.
BAND = 3
#: A span is verified if hits cover so much of the template's k-grams, in percent, ...
COVER_PERCENT = 60
#: ... and if it is no longer than the template by so much, in percent.
LENGTH_PERCENT = 150
#: Template k-grams that may be broadcast; a longer list is joined by a shuffle.
BROADCAST_GRAMS = 500_000

#: Phrases and their labels.
PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)

#: Texts of short licenses and the notices of long ones, whole, with a label for each.
TEXTS = (
    (
        "mit-text",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, "
        "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished "
        "to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. "
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND "
        "NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, "
        "OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    (
        "bsd-3-clause-text",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
        "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
        "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. "
        "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. "
        "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND "
        "FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES "
        "(INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, "
        "STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    ),
    (
        "isc-text",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. "
        "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE "
        "FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, "
        "ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    ),
    (
        "apache-2.0-header",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    ),
    (
        "gpl-3.0-header",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, "
        "or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A "
        "PARTICULAR PURPOSE. See the GNU General Public License for more details. You should have received a copy of the GNU General Public License along with this program. If not, see <https://www.gnu.org/licenses/>.",
    ),
    (
        "mpl-2.0-header",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ),
)

#: Sentences by which licenses are declared, with a label for each, and the texts.
TEMPLATES = (
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("gpl-notice", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("gpl-warranty", "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("apache-2.0-notice", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0."),
    ("cc-by-4.0", "Licensed under CC BY 4.0."),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0."),
    ("mit-release", "Released under the MIT License."),
    ("mit-grant", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("bsd-grant", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    *TEXTS,
)


def normal(text: Column) -> Column:
    """The words of a text in lower case with one space between."""
    return F.trim(F.regexp_replace(F.translate(F.coalesce(text, F.lit("")), ascii_uppercase, ascii_lowercase), r"[\x00-/:-`{-\x7F]+", " "))


def _spaces(x: Column) -> Column:
    return F.length(x) - F.length(F.replace(x, F.lit(" "), F.lit("")))


def template_grams(spark: SparkSession, templates: Sequence[tuple[str, str]] = TEMPLATES, k: int = K) -> DataFrame:
    """(template, label, t, gram, h, grams) of every word k-gram of the templates; shorter templates have none."""
    rows = spark.createDataFrame([(i, label, text) for i, (label, text) in enumerate(templates)], "template int, label string, text string")
    words = rows.select("template", "label", F.split(normal(F.col("text")), " ").alias("w")).where(F.size("w") >= k)
    placed = words.select("template", "label", "w", (F.size("w") - k + 1).alias("grams"), F.explode(F.sequence(F.lit(0), F.size("w") - k)).alias("t"))
    return placed.select("template", "label", "t", "grams", *_gram(k, "t"))


def _gram(k: int, at: str) -> tuple[Column, Column]:
    """The words from this place on as one string, and their hash."""
    words = [F.get("w", F.col(at) + i) for i in range(k)]
    return F.concat_ws(" ", *words).alias("gram"), F.xxhash64(*words).alias("h")


def spans(docs: DataFrame, templates: Sequence[tuple[str, str]] = TEMPLATES, k: int = K) -> DataFrame:
    """(doc_id, text_key, label, first_word, last_word, cover, verified) of the merged spans; cover is from 0 to 1.

    Spans are of a doc_id and a text, text_key being its hash: rows that share both have the same spans, rows that
    share only the doc_id have their own. A place of the template counts once for a span, however often it was hit.
    """
    spark = docs.sparkSession
    grams = template_grams(spark, templates, k)
    if sum(len(t) for _, t in templates) <= BROADCAST_GRAMS:  # a template has fewer k-grams than characters
        grams = F.broadcast(grams)
    normed = docs.select("doc_id", normal(F.col("text")).alias("norm"))
    words = normed.select("doc_id", F.xxhash64("norm").alias("text_key"), F.split("norm", " ").alias("w")).where(F.size("w") >= k)
    places = words.select("doc_id", "text_key", "w", F.explode(F.sequence(F.lit(0), F.size("w") - k)).alias("p"))
    rolling = places.select("doc_id", "text_key", "p", *_gram(k, "p"))
    of = ["doc_id", "text_key", "template", "label", "grams"]
    hits = rolling.join(grams, ["h", "gram"]).select(*of, "p", "t", (F.col("p") - F.col("t")).alias("diagonal"))
    # at most as many places of a template as it has k-grams
    votes = hits.groupBy(*of, "diagonal").agg(F.collect_set("t").alias("ts"), F.min("p").alias("low"), F.max("p").alias("high"))
    by = W.partitionBy("doc_id", "text_key", "template").orderBy("diagonal")
    new = F.when(F.col("diagonal") - F.lag("diagonal").over(by) <= BAND, 0).otherwise(1)
    merged = votes.withColumn("new", new).withColumn("span", F.sum("new").over(by))
    hit = F.size(F.array_distinct(F.flatten(F.collect_list("ts"))))
    return (
        merged.groupBy(*of, "span")
        .agg(hit.alias("votes"), F.min("low").alias("low"), F.max("high").alias("high"))
        .select(
            "doc_id", "text_key", "label", F.col("low").cast("long").alias("first_word"), (F.col("high") + k - 1).cast("long").alias("last_word"),
            (F.col("votes") / F.col("grams")).alias("cover"),
            ((100 * F.col("votes") >= COVER_PERCENT * F.col("grams")) & (100 * (F.col("high") + k - F.col("low")) <= LENGTH_PERCENT * (F.col("grams") + k - 1))).alias("verified"),
        )
    )


def license_labels(docs: DataFrame, phrases: Sequence[tuple[str, str]] = PHRASES, templates: Sequence[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """Per row: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    The score is the best cover of a verified span, else 0.5 if a phrase stands in the text, else half the best cover
    of a span that was not verified. A null or wordless text has no words, no labels and score 0. Each row is judged
    by its own text, so that repeated rows give the same values as one would; other columns are not read, and an empty
    table gives an empty result.
    """
    spaced = F.when(F.col("norm") == "", F.lit("")).otherwise(F.concat(F.lit(" "), F.replace("norm", F.lit(" "), F.lit("  ")), F.lit(" ")))
    n_words = F.when(F.col("norm") == "", F.lit(0)).otherwise(_spaces(F.col("norm")) + 1)
    base = docs.select("doc_id", normal(F.col("text")).alias("norm")).select("doc_id", F.xxhash64("norm").alias("key"), n_words.cast("long").alias("n_words"), F.when(F.col("norm").contains("license") | F.col("norm").contains("cc by"), spaced).otherwise("").alias("x") if _simple(phrases) else spaced.alias("x"))
    n, first, last, labels = [], [], [], []
    for phrase, label in phrases:
        own = " " + phrase.replace(" ", "  ") + " "
        there = F.col("x").contains(own)
        n.append(F.when(there, F.floor((F.length("x") - F.length(F.replace("x", F.lit(own), F.lit("")))) / len(own))).otherwise(0))
        first.append(F.when(there, F.floor(_spaces(F.substring_index("x", own, 1)) / 2)))
        last.append(F.when(there, F.col("n_words") - F.floor(_spaces(F.substring_index("x", own, -1)) / 2) - len(phrase.split())))
        labels.append(F.when(there, F.lit(label)))
    total = n[0]
    for more in n[1:]:
        total = total + more
    base = base.select(
        "doc_id", "key", "n_words", total.cast("long").alias("n_base"), F.least(*first, F.lit(None)).cast("long").alias("first_word"), F.greatest(*last, F.lit(None)).cast("long").alias("last_word"),
        F.sort_array(F.array_distinct(F.array_compact(F.array(*labels)))).alias("own"),
    )
    found = spans(docs, templates).groupBy(F.col("doc_id").alias("id"), "text_key").agg(
        F.collect_set(F.when(F.col("verified"), F.col("label"))).alias("more"), F.max(F.when(F.col("verified"), F.col("cover"))).alias("sure"), F.max("cover").alias("best")
    )  # at most one entry for each template's label
    return base.join(found, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("key") == F.col("text_key")), "left").select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("own", ",").alias("base_labels"),
        F.array_join(F.sort_array(F.array_union("own", F.coalesce("more", F.array().cast("array<string>")))), ",").alias("labels"),
        F.coalesce("sure", F.when(F.col("n_base") > 0, F.lit(0.5)), F.col("best") / 2, F.lit(0.0)).alias("score"),
    )


def _simple(phrases: Sequence[tuple[str, str]]) -> bool:
    """Whether every phrase holds one of the strings that decide if a text is looked at closely."""
    return all("license" in p or "cc by" in p for p, _ in phrases)
