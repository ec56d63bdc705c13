"""License scans: phrases, and an exact set-similarity join of license templates with the corpus' text blocks.

Templates are short notices, whole notices and whole license texts. A block is a line, as the set of its words; a scan can
also take blocks across line ends, windows of twice as many words as the template has, for notices and texts that wrap. A template is found in a block that holds at least a threshold of the
template's distinct words. The join is exact and filters first:

- order: words are ordered by how many blocks of the corpus hold them, rarest first, counted over all documents;
- prefix: a block with enough words of a template holds one of the template's first n - need + 1 words in that order;
- length: it has at least ``need`` words;
- position: with the i-th word of the template the first one that it holds, at most n - i can be shared;
- text: a window meets a template only if the whole text does, so windows are made for such texts and templates only.

Templates are a parameter of known, small size; they and their inverted prefix lists go to every task, and blocks are
joined where they are read, so no text is shuffled. Only counts of template words are.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common as C

#: Phrases whose places are counted, and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
#: Short notices that are looked for as sets of words.
TEMPLATES = {
    "apache": "licensed under the apache license version 2 0",
    "bsd": "redistribution and use in source and binary forms with or without modification are permitted",
    "cc-by-nc": "licensed under cc by nc 4 0",
    "cc-by-sa": "licensed under cc by sa 4 0",
    "cc0": "to the extent possible under law the author has waived all copyright and related rights",
    "gpl": "this work is licensed under the gnu general public license version 3",
    "mit": "released under the mit license",
    "mpl": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "public-domain": "this work has been released into the public domain",
}
#: Whole texts of public licenses, and the whole notices that others ask for.
TEXTS = {
    "apache-2.0-notice": """
        Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with
        the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by
        applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS,
        WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language
        governing permissions and limitations under the License.""",
    "bsd-2-clause": """
        Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
        following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of
        conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright
        notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided
        with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR
        IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A
        PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT,
        INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF
        SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY
        THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN
        ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    "gpl-3.0-notice": """
        This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public
        License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later
        version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the
        implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more
        details. You should have received a copy of the GNU General Public License along with this program. If not, see
        <https://www.gnu.org/licenses/>.""",
    "isc": """
        Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
        granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS
        PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES
        OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR
        CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF
        CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS
        SOFTWARE.""",
    "mit-text": """
        Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
        documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
        rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
        persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice
        and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS
        PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
        MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT
        HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE,
        ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "unlicense": """
        This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use,
        compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose,
        commercial or non-commercial, and by any means.""",
    "zlib": """
        This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held
        liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for
        any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following
        restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original
        software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated
        but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being
        the original software. 3. This notice may not be removed or altered from any source distribution.""",
}
#: With it, templates of fewer than 10 words are met by all of them; one word tells licenses apart.
THRESHOLD = 0.9


def words_of(text: bytes) -> list[bytes]:
    return text.translate(C.WORDS).split()


@dataclass
class Join:
    """Templates as lists of words, rarest first, how many words each needs, the words of its windows, and for each prefix
    word the templates and places where it stands."""

    names: list[str]
    ordered: list[list[bytes]]
    need: list[int]
    reach: list[int]
    prefixes: dict[bytes, list[tuple[int, int]]]

    @classmethod
    def build(cls, templates: dict[str, str], counts: dict[bytes, int], threshold: float) -> Join:
        names, ordered, need, reach, prefixes = [], [], [], [], {}
        for name, text in sorted(templates.items()):
            own = sorted(set(words_of(text.encode())), key=lambda w: (counts.get(w, 0), w))
            if not own:
                continue
            least = max(1, math.ceil(threshold * len(own) - 1e-9))
            for place, w in enumerate(own[: len(own) - least + 1]):
                prefixes.setdefault(w, []).append((len(names), place))
            names.append(name)
            ordered.append(own)
            need.append(least)
            reach.append(2 * len(words_of(text.encode())))
        return cls(names, ordered, need, reach, prefixes)

    def matches(self, block: list[bytes]) -> list[tuple[int, float]]:
        """(template, containment) of those that the block meets."""
        if self.prefixes.keys().isdisjoint(block):
            return []
        own, found = set(block), []
        first: dict[int, int] = {}
        for w in own & self.prefixes.keys():
            for t, place in self.prefixes[w]:
                first[t] = min(place, first.get(t, place))
        for t, place in first.items():
            n, need = len(self.ordered[t]), self.need[t]
            if len(own) < need or n - place < need:
                continue
            shared = sum(w in own for w in self.ordered[t][place:])
            if shared >= need:
                found.append((t, shared / n))
        return found

    def across(self, lines: list[list[bytes]], met: list[tuple[int, int, int, float]]) -> list[tuple[int, int, int, float]]:
        """(template, first word, words, containment) of windows over line ends that meet a template. Of those that
        overlap, the one that holds most, and none that holds no more than a line that it overlaps (met: such rows of
        the lines). A window is cut to the words from which on and up to which it needs them."""
        words = [w for line in lines for w in line]
        line_of = [k for k, line in enumerate(lines) for _ in line]
        out = []
        for t, _ in self.matches(words):
            wanted, need, best = set(self.ordered[t]), self.need[t], None
            hits = [i for i, w in enumerate(words) if w in wanted]
            own = [(first, first + n, share) for u, first, n, share in met if u == t]
            to = 0
            for k, start in enumerate(hits):
                while to < len(hits) and hits[to] < start + self.reach[t]:
                    to += 1
                if to - k < need or line_of[start] == line_of[hits[to - 1]]:
                    continue
                held, end = {words[start]}, start
                for i in hits[k + 1 : to]:
                    if words[i] == words[start]:  # the next window holds no less
                        break
                    if words[i] not in held:
                        held.add(words[i])
                        end = i
                else:
                    share = len(held) / len(wanted)
                    if len(held) < need or line_of[start] == line_of[end] or any(a <= end and start < b and share <= x for a, b, x in own):
                        continue
                    this = (t, start, end + 1 - start, share)
                    if best is None or start >= best[1] + best[2]:
                        out += [best] if best else []
                        best = this
                    elif (share, best[2]) > (best[3], this[2]):
                        best = this
            out += [best] if best else []
        return out


def _count(vocabulary: frozenset[bytes]):
    """Blocks that hold each of the words, summed per batch."""

    def run(batches):
        for batch in batches:
            counts: dict[bytes, int] = {}
            for text in batch.column(0).to_pylist():
                for line in (text or "").encode().translate(_LINES).split(b"\n"):
                    for w in vocabulary.intersection(line.split()):
                        counts[w] = counts.get(w, 0) + 1
            if counts:
                yield pa.record_batch({"word": pa.array([w.decode() for w in counts]), "n": pa.array(list(counts.values()), pa.int64())})

    return run


#: As C.WORDS, with line ends left in place.
_LINES = bytes(10 if c == 10 else C.WORDS[c] for c in range(256))

FIELDS = (("n_words", T.LongType()), ("n_base", T.LongType()), ("first_word", T.LongType()), ("last_word", T.LongType()), ("base_labels", T.StringType()), ("labels", T.StringType()), ("score", T.DoubleType()))
_SPANS = T.ArrayType(T.StructType([T.StructField("label", T.StringType()), T.StructField("first", T.LongType()), T.StructField("words", T.LongType()), T.StructField("containment", T.DoubleType())]))


def _scan(join: Join, phrases: dict[str, str], text_at: int, names: list[str], across_lines: bool):
    known = [(words_of(p.encode()), label) for p, label in phrases.items()]
    starts = {}
    for p, label in known:
        starts.setdefault(p[0], []).append((p, label))
    spans_type = pa.list_(pa.struct([("label", pa.string()), ("first", pa.int64()), ("words", pa.int64()), ("containment", pa.float64())]))

    def scan(text: str | None):
        lines = [line.split() for line in (text or "").encode().translate(_LINES).split(b"\n")]
        words = [w for line in lines for w in line]
        places, base = [], set()
        if not starts.keys().isdisjoint(words):
            for i, w in enumerate(words):
                for p, label in starts.get(w, ()):
                    if words[i : i + len(p)] == p:
                        places.append(i)
                        base.add(label)
        met, at = [], 0
        for line in lines:
            met += [(t, at, len(line), share) for t, share in join.matches(line)]
            at += len(line)
        if across_lines:
            met += join.across(lines, met)
        spans = [{"label": join.names[t], "first": first, "words": n, "containment": share} for t, first, n, share in met]
        labels = base | {s["label"] for s in spans}
        score = 1.0 if places else max((s["containment"] for s in spans), default=0.0)
        return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)), ",".join(sorted(labels)), score, spans

    def run(batches):
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(), spans_type]
        for batch in batches:
            rows = [scan(t) for t in batch.column(text_at).to_pylist()]
            own = zip(*rows, strict=True) if rows else [[]] * len(kinds)
            columns = [*(batch.column(i) for i in range(batch.num_columns)), *(pa.array(list(c), k) for c, k in zip(own, kinds, strict=True))]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def read_templates(spark, path: str, at_most: int = 10_000) -> dict[str, str]:
    """Templates from a folder of text files, a license a file, named by the files without their endings; for more texts than
    are here. More files than at_most raise an error, since templates go to every task."""
    files = spark.read.text(path, wholetext=True).select(F.regexp_extract(F.input_file_name(), r"([^/]+?)(\.[^./]*)?$", 1).alias("name"), "value").limit(at_most + 1).collect()
    if len(files) > at_most:
        raise ValueError(f"more than {at_most} templates")
    return {r["name"]: r["value"] for r in files}


def scan_licenses(docs: DataFrame, templates: dict[str, str] | None = None, phrases: dict[str, str] | None = None, threshold: float = THRESHOLD, text_col: str = "text", across_lines: bool = False) -> DataFrame:
    """All columns of docs and: n_words, n_base (places of the phrases), first_word and last_word (their smallest and
    largest start, else null), base_labels and labels (the phrases', and these with the templates'; distinct, sorted,
    comma-joined), score (1 with a phrase, else the largest containment found, else 0) and spans (every block that meets
    a template: label, first word, words of the block, containment). Blocks are the lines and, if across_lines is set, the
    windows over line ends that hold more of a template than the lines they overlap.

    Null and empty texts have no words, no labels and score 0. Texts are read whole. Input columns with the names of the
    new ones are replaced. An empty table gives none."""
    C.short_batches(docs.sparkSession)
    templates, phrases = TEMPLATES if templates is None else templates, PHRASES if phrases is None else phrases
    text = F.col(text_col).cast("string")
    vocabulary = frozenset(w for t in templates.values() for w in words_of(t.encode()))
    counted = docs.select(text).mapInArrow(_count(vocabulary), "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    counts = {r["word"].encode(): r["n"] for r in counted.collect()}  # at most a row a word of the templates
    join = Join.build(templates, counts, threshold)
    rest = [c for c in docs.columns if c not in {n for n, _ in FIELDS} | {"spans"}]
    given = docs.select(*[text.alias(c) if c == text_col else F.col(c) for c in rest])
    schema = T.StructType([*given.schema.fields, *(T.StructField(n, k) for n, k in FIELDS), T.StructField("spans", _SPANS)])
    return given.mapInArrow(_scan(join, phrases, rest.index(text_col), schema.names, across_lines), schema)


def op9_license_scan(spark, sf_dir: str) -> DataFrame:
    """License notices and whole license texts in all documents, wrapped ones too."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return scan_licenses(docs, TEMPLATES | TEXTS, across_lines=True).select("doc_id", *[n for n, _ in FIELDS])


def oracle_sql() -> str:
    """DuckDB SQL for op9: phrases by position, and containment of each line against each template, without filters.
    It has no windows over line ends, so it agrees with op9 on texts without wrapped notices."""
    lower = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    word = r"'[0-9a-z\x{80}-\x{10FFFF}]+'"
    text = lower.format("coalesce(text, '')")
    quoted = lambda ws: "[" + ", ".join(f"'{w.decode()}'" for w in ws) + "]"
    phrases = ", ".join(f"({quoted(words_of(p.encode()))}, '{label}')" for p, label in PHRASES.items())
    templates = ", ".join(f"('{n}', {quoted(sorted(set(words_of(t.encode()))))})" for n, t in sorted((TEMPLATES | TEXTS).items()))
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, regexp_extract_all({text}, {word}) AS w FROM documents),
p(words, label) AS (VALUES {phrases}),
t(name, words) AS (VALUES {templates}),
b AS (SELECT r, label, i - 1 AS place FROM (SELECT r, w, unnest(range(1, len(w) + 1)) AS i FROM d) JOIN p ON w[i:i + len(words) - 1] = words),
base AS (SELECT r, count(*) AS n_base, min(place) AS first_word, max(place) AS last_word FROM b GROUP BY r),
lines AS (SELECT r, list_distinct(regexp_extract_all({lower.format("line")}, {word})) AS w FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM d)),
m AS (SELECT r, name, CAST(len(list_intersect(words, w)) AS DOUBLE) / len(words) AS share FROM lines CROSS JOIN t WHERE len(list_intersect(words, w)) >= ceil({THRESHOLD} * len(words) - 1e-9)),
shares AS (SELECT r, max(share) AS share FROM m GROUP BY r),
bl AS (SELECT r, string_agg(label, ',' ORDER BY label) AS s FROM (SELECT DISTINCT r, label FROM b) GROUP BY r),
al AS (SELECT r, string_agg(label, ',' ORDER BY label) AS s FROM (SELECT r, label FROM b UNION SELECT r, name FROM m) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(bl.s, '') AS base_labels, coalesce(al.s, '') AS labels,
       CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(share, 0.0)::DOUBLE END AS score
FROM d LEFT JOIN base USING (r) LEFT JOIN shares USING (r) LEFT JOIN bl USING (r) LEFT JOIN al USING (r)
"""


OP9_SQL = oracle_sql()
