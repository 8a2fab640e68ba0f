"""Licence scans by canonical digests.

A text is normalised: case, copyright lines, punctuation, white space and equivalent
spellings. The digest of the whole text, and of each of its lines, is joined by hash to the
digests of known licence texts and notices, normalised alike. Everything is DataFrame
expressions.
"""

from pyspark.sql import functions as F

from ledgerline.llm.shared import broadcast_if_small, text_of

# Licences and their short notices, by SPDX identifier.
KNOWN = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "This work is licensed under the Apache License, version 2.0."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "Licensed under the Mozilla Public License, version 2.0."),
    ("CC0-1.0", "Licensed under CC0 1.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    (
        "MIT",
        """MIT License

Permission is hereby granted, free of charge, to any person obtaining a copy of this
software and associated documentation files (the "Software"), to deal in the Software
without restriction, including without limitation the rights to use, copy, modify, merge,
publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons
to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or
substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED,
INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR
PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE
FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER
DEALINGS IN THE SOFTWARE.""",
    ),
    (
        "ISC",
        """ISC License

Permission to use, copy, modify, and/or distribute this software for any purpose with or
without fee is hereby granted, provided that the above copyright notice and this permission
notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS
SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL
THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY
DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF
CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE
OR PERFORMANCE OF THIS SOFTWARE.""",
    ),
    (
        "BSD-2-Clause",
        """Redistribution and use in source and binary forms, with or without modification, are
permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of
conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of
conditions and the following disclaimer in the documentation and/or other materials provided
with the distribution.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS
OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF
MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE
COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL,
EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF
SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION)
HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT
(INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN
IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    ),
    (
        "BSD-2-Clause",
        """BSD 2-Clause License

Redistribution and use in source and binary forms, with or without modification, are
permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of
conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of
conditions and the following disclaimer in the documentation and/or other materials provided
with the distribution.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS
OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF
MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE
COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL,
EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF
SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION)
HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT
(INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN
IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    ),
    (
        "BSD-3-Clause",
        """Redistribution and use in source and binary forms, with or without modification, are
permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of
conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of
conditions and the following disclaimer in the documentation and/or other materials provided
with the distribution.

3. Neither the name of the copyright holder nor the names of its contributors may be used to
endorse or promote products derived from this software without specific prior written
permission.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS
OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF
MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE
COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL,
EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF
SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION)
HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT
(INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN
IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    ),
    (
        "BSD-3-Clause",
        """BSD 3-Clause License

Redistribution and use in source and binary forms, with or without modification, are
permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of
conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of
conditions and the following disclaimer in the documentation and/or other materials provided
with the distribution.

3. Neither the name of the copyright holder nor the names of its contributors may be used to
endorse or promote products derived from this software without specific prior written
permission.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS
OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF
MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE
COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL,
EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF
SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION)
HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT
(INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN
IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    ),
)
# Canonical digests of the published texts of licences, as :func:`digest` gives
# them; where a text goes on after the end of its terms, also of the terms alone.
DIGESTS = (
    ("Apache-2.0", "441c2e2f1c9c930d1ca6b12943e7625b8209010a79bd84b3670d39e334263636"),
    ("Apache-2.0", "65baedad38ee86dc6d0ec65e4f1caa0d03aef29eb2c0fc01251b23e57eeaaa0c"),
    ("Artistic-1.0-Perl", "08f1dc258c8f9e175155356aa1dd0dead8cfdec586bc1bb4c8b1452699a91702"),
    ("CC-BY-SA-4.0", "6fd32d7fe30fa66c101714769c97e3e375bdf90cc19532508e2dfb4d98a92a9d"),
    ("CC0-1.0", "96bdc7f63190fb4bd1ae584b890300ed7517d858b34c945642a3b9b2f1612a5f"),
    ("GFDL-1.2", "187a96a494029ebd41e70c03b8a3e0436d5d34cdd042a4e3ca190290334b7646"),
    ("GFDL-1.3", "c68410bc365648dcf4dd77ba88bcf1eaa1b6e6bf015d834c150d2221696943d4"),
    ("GPL-1.0", "d9b8ba84cf446891218ba79f7f4dd80d65e69f510cce91a53bee0a87f760b5d9"),
    ("GPL-1.0", "6375a768fd262bf5281905a9585411d2d0fb4ea15cb08cfcba49f73fedb82abc"),
    ("GPL-2.0", "10e7e575e86a75a05d72be979351d9676e94cbab1bf047db27423120c96c8afc"),
    ("GPL-2.0", "e1270b653c300290e7c039142bccb8776f9b5d14e8a05bc4e87dc7d1614a3b34"),
    ("GPL-2.0", "0c6226b8b57584fa365889445736057eb0dda8f8d24b0ff4ec1cf59998ac5656"),
    ("GPL-3.0", "3b87302f6b727d90ee70cb7a369870f4f6fd7b53ff1439e01c1214cd1933509c"),
    ("GPL-3.0", "ac6b52d57c0104e687039148f7b8e370e04c9bb5705bb786f8ef814eb65e8636"),
    ("GPL-3.0", "524734282dfb50d18fbb1c7b2c16e3d0b925f3b4dc6c22d74f31683724f4e803"),
    ("LGPL-2.0", "83df1d66af65fd8cb766ed11d5d6fb001a54de029acd487c0ef9cef23f29a425"),
    ("LGPL-2.0", "504542bce5421b0f5a7e63ddb55443ccb300b27a65ba6bfc1370fed16a3af260"),
    ("LGPL-2.1", "c9b8d47c6e4ea3eeede95546242a868e1315ed12d2541bf450f7fe7a73e7f387"),
    ("LGPL-2.1", "48d2010e70a815a564f914b0c7c1e80d7a6843793348fed3684c957112fe0aa4"),
    ("LGPL-3.0", "aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be"),
    ("MPL-1.1", "f7c89cf317d00f6bcce724a87c04df4230cd169e3102aafd4314f8878bb4b379"),
    ("MPL-2.0", "b104cf5b930ac6842c198a4ec5560379f033bec0236a2adce6ddb0b40f0553fa"),
)
# Spellings taken as equal, in lower case, the second standing for both.
SPELLINGS = (
    ("licence", "license"),
    ("licencing", "licensing"),
    ("sub-license", "sublicense"),
    ("acknowledgement", "acknowledgment"),
    ("judgement", "judgment"),
    ("favour", "favor"),
    ("organisation", "organization"),
    ("non-commercial", "noncommercial"),
    ("non-infringement", "noninfringement"),
    ("copyright owner", "copyright holder"),
    ("https://", "http://"),
    ("(c)", "©"),
)
# A line whose first word says copyright and that names a year, or reserves all rights.
COPYRIGHT_LINE = (
    r"(^|\n)[^\p{L}\p{N}\n©]*"
    r"(?:(?:copyright|©)[^\p{L}\p{N}\n]*[0-9]{4}[^\n]*|all rights reserved[^\p{L}\p{N}\n]*)"
)
PUNCTUATION = r"[^\p{L}\p{N}\n]+"
BROADCAST_ROWS = 100_000


def canonical_lines(text):
    """The normalised lines of a text in order, without empty ones."""
    plain = F.lower(text)
    for old, new in SPELLINGS:
        plain = F.replace(plain, F.lit(old), F.lit(new))
    plain = F.regexp_replace(plain, COPYRIGHT_LINE, "$1")
    spaced = F.regexp_replace(plain, PUNCTUATION, " ")
    return F.filter(
        F.transform(F.split(spaced, "\n"), lambda line: F.btrim(line)), lambda line: line != ""
    )


def digest(words):
    return F.sha2(words, 256)


def known_digests(spark, known=KNOWN, digests=DIGESTS):
    """(digest, license_id) of known texts and given digests; the first of equal texts names it."""
    given = spark.createDataFrame([(d, i) for i, d in digests], "digest string, license_id string")
    rows = spark.createDataFrame(
        [(n, i, t) for n, (i, t) in enumerate(known)], "place int, license_id string, text string"
    )
    named = (
        rows.select(
            digest(F.array_join(canonical_lines(F.col("text")), " ")).alias("digest"),
            F.struct("place", "license_id").alias("named"),
        )
        .groupBy("digest")
        .agg(F.min("named")["license_id"].alias("license_id"))
    )
    return named.unionByName(given.join(named, "digest", "left_anti"))


def scan_licenses(docs, known=None):
    """One row per row of ``docs``: what its whole text and its lines are known as.

    Columns: doc_id, canonical_sha256, license_id (of the whole text, or null), notices
    (the identifiers of its lines, each once, sorted, comma-joined, empty for none) and
    n_notices (the number of such lines). A null text is an empty one, whose canonical text
    is empty and no licence; a null doc_id is kept; repeated rows are scanned alike; an
    empty table gives no rows. ``known`` is a table as :func:`known_digests` gives it. Only
    ``doc_id`` and ``text`` are read.
    """
    known = known_digests(docs.sparkSession) if known is None else known
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("doc_id").cast("long"),
        canonical_lines(text_of()).alias("lines"),
    )
    units = rows.select(
        "row",
        "doc_id",
        F.explode(
            F.concat(
                F.array(
                    F.struct(
                        F.lit(True).alias("whole"),
                        digest(F.array_join("lines", " ")).alias("digest"),
                    )
                ),
                F.transform(
                    "lines",
                    lambda line: F.struct(F.lit(False).alias("whole"), digest(line).alias("digest")),
                ),
            )
        ).alias("unit"),
    ).select("row", "doc_id", "unit.whole", "unit.digest")
    found = units.join(broadcast_if_small(known, BROADCAST_ROWS), "digest", "left").where(
        "whole or license_id is not null"
    )
    line = F.when(~F.col("whole"), F.col("license_id"))
    return (
        found.groupBy("row", "doc_id")
        .agg(
            F.max(F.when(F.col("whole"), F.col("digest"))).alias("canonical_sha256"),
            F.max(F.when(F.col("whole"), F.col("license_id"))).alias("license_id"),
            F.array_join(F.sort_array(F.collect_set(line)), ",").alias("notices"),
            F.count(line).alias("n_notices"),
        )
        .drop("row")
    )


def _sql_text(text):
    return "'" + text.replace("'", "''") + "'"


def _sql_lines(column):
    plain = f"lower({column})"
    for old, new in SPELLINGS:
        plain = f"replace({plain}, {_sql_text(old)}, {_sql_text(new)})"
    plain = f"regexp_replace({plain}, {_sql_text(COPYRIGHT_LINE)}, '\\1', 'g')"
    spaced = f"regexp_replace({plain}, {_sql_text(PUNCTUATION)}, ' ', 'g')"
    return (
        f"list_filter(list_transform(string_split({spaced}, chr(10)), lambda x: trim(x)), lambda x: x <> '')"
    )


def oracle(known=KNOWN, digests=DIGESTS):
    """DuckDB SQL for the same rows over ``documents``, whose doc_ids differ."""
    given = ", ".join(f"({_sql_text(d)}, {_sql_text(i)})" for i, d in digests)
    values = ", ".join(f"({n}, {_sql_text(i)}, {_sql_text(t)})" for n, (i, t) in enumerate(known))
    return f"""
WITH texts(place, license_id, text) AS (VALUES {values}),
known AS (
  SELECT sha256(list_aggregate({_sql_lines("text")}, 'string_agg', ' ')) AS digest,
         arg_min(license_id, place) AS license_id
  FROM texts GROUP BY 1
  UNION ALL SELECT * FROM (VALUES {given})),
rows AS (SELECT doc_id, {_sql_lines("coalesce(text, '')")} AS lines FROM documents),
whole AS (
  SELECT doc_id, sha256(coalesce(list_aggregate(lines, 'string_agg', ' '), '')) AS digest FROM rows),
notes AS (
  SELECT r.doc_id, string_agg(DISTINCT k.license_id, ',' ORDER BY k.license_id) AS notices,
         count(*) AS n_notices
  FROM (SELECT doc_id, unnest(lines) AS line FROM rows) r
  JOIN known k ON k.digest = sha256(r.line) GROUP BY 1)
SELECT w.doc_id, w.digest AS canonical_sha256, k.license_id,
       coalesce(n.notices, '') AS notices, coalesce(n.n_notices, 0) AS n_notices
FROM whole w LEFT JOIN known k ON k.digest = w.digest LEFT JOIN notes n ON n.doc_id = w.doc_id
"""
