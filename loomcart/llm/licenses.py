"""License scans: TF-IDF cosine of headers and licence files to templates, and inheritance.

Every group of consecutive lines of a file, and the file as a whole, is compared with the
notices, headers and texts of known licences by the cosine of sparse TF-IDF vectors. A group
near one of them declares a licence; a file that is nearly nothing but one, or that is named
as a licence file and declares one, is a licence file of its directory.
Files without a declaration inherit from the nearest directory above them that has a
licence file, found by joining the directories with their ancestors.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomcart.llm.common import checked_broadcast, stored

# Short notices as the licences' own texts and their publishers state them.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0",
     "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0",
     "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC0-1.0", "Released under CC0 1.0 Universal public domain dedication."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("ISC", "Licensed under the ISC License."),
    ("LGPL-2.1", "This work is licensed under the GNU Lesser General Public License, version 2.1."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)
# licences' full texts, file headers, titles and identifiers as published.
_MIT_GRANT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this
software and associated documentation files (the "Software"), to deal in the Software without restriction,
including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or
sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the
following conditions: The above copyright notice and this permission notice shall be included in all copies or
substantial portions of the Software."""
_MIT_WARRANTY = """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING
BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO
EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN
ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER
DEALINGS IN THE SOFTWARE."""
_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE
SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER
IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
PERFORMANCE OF THIS SOFTWARE."""
_BSD_GRANT = """Redistribution and use in source and binary forms, with or without modification, are permitted
provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright
notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the
above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other
materials provided with the distribution."""
_BSD_NAMES = """3. Neither the name of the copyright holder nor the names of its contributors may be used to
endorse or promote products derived from this software without specific prior written permission."""
_BSD_WARRANTY = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR
IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A
PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT,
INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF
SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY
THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN
ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_APACHE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0
Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on
an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the
specific language governing permissions and limitations under the License."""
_MPL = """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL
was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."""
_UNLICENSE = """This is free and unencumbered software released into the public domain. Anyone is free to copy,
modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled
binary, for any purpose, commercial or non-commercial, and by any means."""
_GNU = """This {what} is free software; you can redistribute it and/or modify it under the terms of the {name} as
published by the Free Software Foundation, either version {version} of the License, or (at your option) any later
version. This {what} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the
implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the {name} for more details. You should
have received a copy of the {name} along with this {what}. If not, see http://www.gnu.org/licenses/."""
GNU_LICENSES = (
    ("GPL-2.0", "GNU General Public License", "2", "program", "June 1991"),
    ("GPL-3.0", "GNU General Public License", "3", "program", "29 June 2007"),
    ("LGPL-2.1", "GNU Lesser General Public License", "2.1", "library", "February 1999"),
    ("LGPL-3.0", "GNU Lesser General Public License", "3", "library", "29 June 2007"),
    ("AGPL-3.0", "GNU Affero General Public License", "3", "program", "19 November 2007"),
)
TEMPLATES += (
    ("MIT", f"{_MIT_GRANT} {_MIT_WARRANTY}"), ("MIT", _MIT_GRANT), ("ISC", _ISC),
    ("BSD-2-Clause", f"{_BSD_GRANT} {_BSD_WARRANTY}"), ("BSD-3-Clause", f"{_BSD_GRANT} {_BSD_NAMES} {_BSD_WARRANTY}"),
    ("Apache-2.0", _APACHE), ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"),
    ("MPL-2.0", _MPL), ("MPL-2.0", "Mozilla Public License Version 2.0"), ("Unlicense", _UNLICENSE),
)
TEMPLATES += tuple((key, _GNU.format(name=name, version=version, what=what))
                   for key, name, version, what, _ in GNU_LICENSES)
TEMPLATES += tuple((key, f"{name} Version {version}, {date}") for key, name, version, _, date in GNU_LICENSES)
TEMPLATES += tuple((key, f"SPDX-License-Identifier: {key}") for key in sorted({key for key, _ in TEMPLATES}))
FILE_NAMES = r"(?i)(^|/)(licen[cs]e|copying|unlicense)[^/]*$"  # names of licence files
HEADER_CUT = 0.8  # cosine from which a group of lines declares a licence
FILE_CUT = 0.5  # cosine from which a whole file is a licence file
GROUP_WORDS = 2  # a group of several lines has at most so many times the template's words
_TERM = re.compile(r"[a-z]+|[0-9]+(?:\.[0-9]+)*")
_SPDX = "spdx"


def terms(text: str) -> list[str]:
    return _TERM.findall(text.lower())


def needed_terms(name: str, text: str) -> set[str]:
    """Terms without which no words are taken for this template: the numbers of its
    version, which alone tell licences of a family apart, and all of an identifier's."""
    found = set(terms(text))
    if _SPDX in found:
        return found
    version = set(re.findall(r"[0-9]+(?:\.[0-9]+)*", name))
    return found & (version | {v.removesuffix(".0") for v in version})


class Matcher:
    """Cosines to the templates. ``rarity`` has the IDF of the templates' terms; other
    terms are taken to be as rare as can be."""

    def __init__(self, templates, rarity: dict[str, float], other: float) -> None:
        self.rarity, self.other = rarity, other
        self.names = [name for name, _ in templates]
        self.needed = [needed_terms(*template) for template in templates]
        self.sizes = [len(terms(text)) for _, text in templates]
        self.vectors = []
        for _, text in templates:
            vector = {t: n * rarity[t] for t, n in Counter(terms(text)).items()}
            norm = math.sqrt(sum(w * w for w in vector.values()))
            self.vectors.append({t: w / norm for t, w in vector.items()})

    def within_reach(self, present: set[str], cut: float) -> list[int]:
        """Templates to which some words out of ``present`` may have a cosine of ``cut``: no
        cosine is above the length of the template's vector over the terms that are there."""
        known = present & self.rarity.keys()
        least = 0.99 * cut * cut
        return [i for i, v in enumerate(self.vectors) if self.needed[i] <= known
                and sum(w * w for t, w in v.items() if t in known) >= least]

    def cosine(self, i: int, counts: Counter) -> float:
        if not self.needed[i] <= counts.keys():
            return 0.0
        norm = math.sqrt(sum((n * self.rarity.get(t, self.other)) ** 2 for t, n in counts.items()))
        return sum(w * counts[t] * self.rarity[t] for t, w in self.vectors[i].items() if t in counts) / norm

    def whole(self, counts: Counter, near: list[int]) -> tuple[float, str | None]:
        """Greatest cosine of all words and its licence; of equal ones the first by name."""
        return min(((-round(self.cosine(i, counts), 12), self.names[i]) for i in near), default=(0.0, None))

    def groups(self, lines: list[list[str]], near: list[int]):
        """(-cosine, name, first line, line after the last) of each line, and of each group of lines
        that starts with a term of a template and has at most GROUP_WORDS times its words."""
        for i in near:
            vector, most = self.vectors[i], GROUP_WORDS * self.sizes[i]
            for start, first in enumerate(lines):
                if not any(t in vector for t in first):
                    continue
                # The products of the group's vector with the template's and with itself.
                counts, product, square, words = Counter(), 0.0, 0.0, 0
                for stop in range(start, len(lines)):
                    words += len(lines[stop])
                    if stop > start and words > most:
                        break
                    for t in lines[stop]:
                        weight = self.rarity.get(t, self.other)
                        square += (2 * counts[t] + 1) * weight * weight
                        product += vector.get(t, 0.0) * weight
                        counts[t] += 1
                    if lines[stop] and self.needed[i] <= counts.keys():
                        yield -round(product / math.sqrt(square), 12), self.names[i], start, stop + 1

    def declared(self, text: str, found: list[str], cut: float) -> tuple[float, list[str]]:
        """Greatest cosine of a group of lines, and the licences of the groups at or above
        ``cut``, nearest first, each line taken once."""
        near = self.within_reach(set(found), cut)
        if not near:
            return 0.0, []
        top, taken, names = 0.0, set(), []
        lines = [terms(line) for line in text.split("\n")]
        for cosine, name, start, stop in sorted(self.groups(lines, near)):
            top = max(top, -cosine)
            if -cosine < cut:
                break
            if taken.isdisjoint(range(start, stop)):
                taken.update(range(start, stop))
                names.append(name)
        return top, list(dict.fromkeys(names))


def rarities(files: DataFrame, templates=TEMPLATES) -> tuple[dict[str, float], float]:
    """IDF of the templates' terms over all files, and that of a term in no file. One
    number per term reaches the driver."""
    known = sorted({t for _, text in templates for t in terms(text)})

    def count(batches):
        seen: Counter = Counter()
        for batch in batches:
            for text in batch.column(0).cast(pa.large_string()):
                seen.update(set(terms(text.as_py())).intersection(known))
                seen[""] += 1
        yield pa.RecordBatch.from_pydict({"term": pa.array(list(seen), pa.string()),
                                          "n": pa.array(list(seen.values()), pa.int64())})

    counted = files.select(F.coalesce("text", F.lit("")).alias("text")).mapInArrow(count, "term string, n long")
    counts = dict(counted.groupBy("term").agg(F.sum("n")).collect())
    total = counts.pop("", 0)
    return ({t: 1 + math.log((total + 1) / (counts.get(t, 0) + 1)) for t in known}, 1 + math.log(total + 1))


def declared(files: DataFrame, templates=TEMPLATES, header_cut: float = HEADER_CUT,
             file_cut: float = FILE_CUT) -> DataFrame:
    """file_id, path, header and header_cosine (nearest group of lines), licenses (all that
    are declared, nearest first), whole and whole_cosine (the file's text) of every row;
    names are null and licenses empty below the cuts. A cosine is 0 where none can reach
    its cut."""
    rarity, other = rarities(files, templates)

    def scan(batches):
        matcher = Matcher(templates, rarity, other)
        for batch in batches:
            out = []
            for text in batch.column(2).cast(pa.large_string()):
                text = text.as_py()
                found = terms(text)
                near = matcher.within_reach(set(found), file_cut)
                cosine, whole = matcher.whole(Counter(found), near) if near else (0.0, None)
                top, names = matcher.declared(text, found, header_cut) if near or header_cut < file_cut else (0.0, [])
                out.append((names[0] if names else None, top, names, whole if -cosine >= file_cut else None, -cosine))
            kinds = (pa.string(), pa.float64(), pa.list_(pa.string()), pa.string(), pa.float64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *(pa.array([o[i] for o in out], k) for i, k in enumerate(kinds))],
                names=["file_id", "path", "header", "header_cosine", "licenses", "whole", "whole_cosine"])

    narrow = files.select(F.col("file_id").cast("long").alias("file_id"), F.col("path").cast("string").alias("path"),
                          F.coalesce("text", F.lit("")).alias("text"))
    return narrow.mapInArrow(scan, "file_id long, path string, header string, header_cosine double, "
                                   "licenses array<string>, whole string, whole_cosine double")


def directory(path: Column) -> Column:
    """What stands before the last slash; empty at the top."""
    return F.regexp_extract(path, "^(.*)/[^/]*$", 1)


def scan(files: DataFrame, templates=TEMPLATES, header_cut: float = HEADER_CUT,
         file_cut: float = FILE_CUT) -> DataFrame:
    """One row per row of ``files`` (file_id, path, text): file_id, path, license, origin
    (header, inherited or none), cosine (of the nearest group of lines), from_directory and
    licenses (all declared ones or the inherited one, joined by commas).

    Of several licence files in a directory the nearest to its template counts, then the
    last by name of the licence. A null path has no directory and inherits nothing; a null or empty text
    declares nothing. Of equally near notices the first by name counts. Repeated rows give
    repeated rows; an empty table gives none; other columns are not read.
    """
    rows = stored(declared(files, templates, header_cut, file_cut).withColumn("dir", directory(F.col("path"))), "declared")
    by_name = F.col("path").rlike(FILE_NAMES) & F.col("header").isNotNull()
    owner = F.when(by_name & (F.col("whole").isNull() | (F.col("header_cosine") > F.col("whole_cosine"))),
                   F.struct(F.col("header_cosine").alias("cosine"), F.col("header").alias("name"))).when(
        F.col("whole").isNotNull(), F.struct(F.col("whole_cosine").alias("cosine"), F.col("whole").alias("name")))
    owners = (rows.where("path is not null").select("dir", owner.alias("top")).where("top is not null")
              .groupBy("dir").agg(F.max("top").alias("top"))
              .select(F.col("dir").alias("owner"), F.col("top.name").alias("owned")))
    owners = stored(owners, "owners")
    # Only directories are joined with their ancestors, not files.
    dirs = rows.where("header is null and path is not null").select("dir").distinct()
    parts = F.split("dir", "/")
    depths = F.sequence(F.lit(0), F.size(parts))
    above = dirs.select("dir", F.explode(F.transform(depths, lambda d: F.struct(
        d.alias("depth"), F.array_join(F.slice(parts, F.lit(1), d), "/").alias("owner")))).alias("a")).select("dir", "a.*")
    nearest = (above.join(checked_broadcast(owners, owners.count()), "owner").groupBy("dir")
               .agg(F.max(F.struct("depth", "owner", "owned")).alias("n"))
               .select("dir", F.col("n.owner").alias("from_directory"), F.col("n.owned").alias("inherited")))
    nearest = stored(nearest, "nearest")
    joined = rows.join(checked_broadcast(nearest, nearest.count()), "dir", "left")
    inherits = F.col("header").isNull() & F.col("path").isNotNull()
    inherited = F.when(inherits, F.col("inherited"))
    return joined.select(
        "file_id", "path", F.coalesce("header", inherited).alias("license"),
        F.when(F.col("header").isNotNull(), "header").when(inherited.isNotNull(), "inherited").otherwise("none")
        .alias("origin"),
        F.col("header_cosine").alias("cosine"), F.when(inherits, F.col("from_directory")).alias("from_directory"),
        F.coalesce(F.when(F.col("header").isNotNull(), F.array_join("licenses", ",")), inherited).alias("licenses"))
