"""Licence lookup by digests of canonical texts.

A text is made canonical: lower case, copyright lines dropped, everything but
letters and digits turned into single blanks, equivalent spellings made one.
The SHA-256 of the canonical entire text, and of each of its lines, is
hash-joined with the digests of the known licences and notices.  Only
built-in Spark functions are used.

Edge cases: NULL text counts as empty; an empty canonical text or line matches
nothing; every row is reported once, repeated rows each; the known texts are a
fixed table of this module, so they may be broadcast.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spreadlab.llm.text import is_set

COPYRIGHT = "(?m)^[^a-z0-9\n]*(copyright|\\(c\\)|©|all rights reserved)[^\n]*$"
# Spellings that mean the same, applied in this order to the blank-separated words.
SPELLINGS = (
    ("licenc", "licens"), ("favour", "favor"), ("organis", "organiz"), ("authoris", "authoriz"),
    ("modelled", "modeled"), ("behaviour", "behavior"), ("non infring", "noninfring"), ("sub licens", "sublicens"),
    ("per cent", "percent"), ("https ", "http "), ("merchantibility", "merchantability"), ("v 2 0", "version 2 0"),
)
_AS_IS = ('THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE '
          'WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR '
          'COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR '
          'OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.')
_AUTHOR = ('THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL '
           'IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, '
           'INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN '
           'AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR '
           'PERFORMANCE OF THIS SOFTWARE.')
_BSD = ('Redistribution and use in source and binary forms, with or without modification, are permitted provided that the '
        'following conditions are met:\n1. Redistributions of source code must retain the above copyright notice, this list of '
        'conditions and the following disclaimer.\n2. Redistributions in binary form must reproduce the above copyright notice, '
        'this list of conditions and the following disclaimer in the documentation and/or other materials provided with the '
        'distribution.\n')
_BSD_3 = ('3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote '
          'products derived from this software without specific prior written permission.\n')
_BSD_END = ('THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, '
            'INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE '
            'DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, '
            'SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR '
            'SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, '
            'WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE '
            'OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.')
# Licences and notices by their SPDX identifiers.
KNOWN = (
    ("MIT", 'MIT License\nPermission is hereby granted, free of charge, to any person obtaining a copy of this software and '
            'associated documentation files (the "Software"), to deal in the Software without restriction, including without '
            'limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the '
            'Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:\n'
            'The above copyright notice and this permission notice shall be included in all copies or substantial portions of '
            'the Software.\n' + _AS_IS),
    ("ISC", 'Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby '
            'granted, provided that the above copyright notice and this permission notice appear in all copies.\n' + _AUTHOR),
    ("0BSD", 'Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby '
             'granted.\n' + _AUTHOR),
    ("BSD-2-Clause", _BSD + _BSD_END),
    ("BSD-3-Clause", _BSD + _BSD_3 + _BSD_END),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
                   'compliance with the License. You may obtain a copy of the License at\nhttp://www.apache.org/licenses/LICENSE-2.0\n'
                   'Unless required by applicable law or agreed to in writing, software distributed under the License is '
                   'distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. '
                   'See the License for the specific language governing permissions and limitations under the License.'),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0-only", "Licensed under the GNU General Public License, version 3."),
    ("GPL-3.0-only", "SPDX-License-Identifier: GPL-3.0-only"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under the Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC0-1.0", "Released under CC0 1.0."),
)


def canonical(text: Column) -> Column:
    """Canonical form; line feeds stay, so that the lines' forms can be cut from it."""
    out = F.lower(text)
    out = F.when(F.contains(out, F.lit("copyright")) | F.contains(out, F.lit("(c)")) | F.contains(out, F.lit("©"))
                 | F.contains(out, F.lit("all rights reserved")), F.regexp_replace(out, COPYRIGHT, "")).otherwise(out)
    out = F.regexp_replace(out, "[^a-z0-9\n]+", " ")
    for other, one in SPELLINGS:
        out = F.replace(out, F.lit(other), F.lit(one))
    return out


def canonical_text(text: str) -> str:
    """The same for the known texts, with their lines joined."""
    out = re.sub(COPYRIGHT, "", text.lower())
    out = re.sub("[^a-z0-9\n]+", " ", out)
    for other, one in SPELLINGS:
        out = out.replace(other, one)
    return " ".join(out.split())


def known_digests() -> list[tuple[str, str]]:
    """(digest, licence) of the known texts, each digest once."""
    return sorted({hashlib.sha256(canonical_text(text).encode()).hexdigest(): name for name, text in KNOWN}.items())


def known_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(known_digests(), "k_digest string, license string")


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, digest of the entire canonical text, its licence (or NULL), and the licences its lines name.

    ``notices`` joins the licences found on lines, in order of their names; ``n_notices`` counts such lines.
    """
    known = known_table(docs.sparkSession)
    forms = docs.select(F.monotonically_increasing_id().alias("row"), F.col(doc_id).alias("doc_id"),
                        canonical(is_set(F.col(text))).alias("form"))
    entire = F.sha2(F.trim(F.regexp_replace("form", "[ \n]+", " ")), 256)
    parts = F.transform(F.split("form", "\n", -1), lambda line: F.sha2(F.trim(line), 256))
    rows = forms.select("row", "doc_id", entire.alias("digest"), parts.alias("parts"))
    units = rows.select("row", "doc_id", "digest", F.explode(F.concat(F.array("digest"), "parts")).alias("k_digest"),
                        ).join(F.broadcast(known), "k_digest", "left")  # a table of fixed size
    per_row = units.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"), F.first("digest").alias("digest"),
        F.max(F.when(F.col("k_digest") == F.col("digest"), F.col("license"))).alias("license"),
        F.array_join(F.array_sort(F.collect_set("license")), ",").alias("notices"),
        F.count("license").alias("units"))
    whole = F.col("license").isNotNull().cast("long")
    return per_row.select("doc_id", "digest", "license", "notices", (F.col("units") - whole).alias("n_notices"))


def _sql() -> str:
    form = "lower(coalesce(text, ''))"
    form = f"regexp_replace({form}, '{COPYRIGHT}', '', 'g')"
    form = f"regexp_replace({form}, '[^a-z0-9\\n]+', ' ', 'g')"
    for other, one in SPELLINGS:
        form = f"replace({form}, '{other}', '{one}')"
    values = ", ".join(f"('{d}', '{name}')" for d, name in known_digests())
    return f"""
WITH known(k_digest, license) AS (VALUES {values}),
forms AS (SELECT row_number() OVER () AS row, doc_id, {form} AS form FROM documents),
rows AS (SELECT row, doc_id, sha256(trim(regexp_replace(form, '[ \\n]+', ' ', 'g'))) AS digest,
                list_transform(string_split(form, chr(10)), lambda x: sha256(trim(x))) AS parts FROM forms),
units AS (SELECT row, doc_id, digest, unnest(list_concat([digest], parts)) AS k_digest FROM rows),
hits AS (SELECT u.*, k.license FROM units u LEFT JOIN known k USING (k_digest)),
per_row AS (
  SELECT row, any_value(doc_id) AS doc_id, any_value(digest) AS digest, max(license) FILTER (k_digest = digest) AS license,
         coalesce(string_agg(DISTINCT license, ',' ORDER BY license), '') AS notices, count(license) AS units
  FROM hits GROUP BY row)
SELECT doc_id, digest, license, notices, units - CASE WHEN license IS NULL THEN 0 ELSE 1 END AS n_notices FROM per_row"""


SQL = _sql()
