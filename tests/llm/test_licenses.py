import math
from collections import Counter

from odd import documents, empty
from pyspark.sql import functions as F

from loomcart.llm import licenses as L


def files(spark, rows):
    return spark.createDataFrame([(i, p, t, "x", 1.0) for i, (p, t) in enumerate(rows)],
                                 "file_id long, path string, text string, dir string, whole double")


def brute(rows, header_cut=L.HEADER_CUT, file_cut=L.FILE_CUT):
    known = {t for _, x in L.TEMPLATES for t in L.terms(x)}
    df = Counter(t for _, x in rows for t in set(L.terms(x or "")) & known)
    idf = lambda t: 1 + math.log((len(rows) + 1) / (df[t] + 1))

    def cosine(a, b):
        a, b = Counter(L.terms(a)), Counter(L.terms(b))
        norm = lambda v: math.sqrt(sum((n * idf(t)) ** 2 for t, n in v.items()))
        return sum(n * b[t] * idf(t) ** 2 for t, n in a.items()) / (norm(a) * norm(b)) if a and b else 0.0

    def best(text, cut):
        found = [(cosine(text, x), name) for name, x in L.TEMPLATES]
        top = max(c for c, _ in found)
        return (top, min(n for c, n in found if c >= top - 1e-12)) if top >= cut else (top, None)

    headers, owners = [], {}
    for path, text in rows:
        lines = [best(x, header_cut) for x in (text or "").split("\n")]
        hits = [x for x in lines if x[1]]
        headers.append(max(hits)[1] if hits else None)
        score, name = best(text or "", file_cut)
        if name and path is not None:
            folder = path.rpartition("/")[0]
            owners[folder] = max(owners.get(folder, (0, "")), (score, name))
    out = []
    for (path, _), header in zip(rows, headers):
        origin, name = ("header", header) if header else ("none", None)
        folder = path.rpartition("/")[0] if path is not None else None
        while header is None and folder is not None:
            if folder in owners:
                origin, name = "inherited", owners[folder][1]
                break
            folder = folder.rpartition("/")[0] if folder else None
        out.append((name, origin))
    return out


ROWS = [
    ("LICENSE", "Released under the MIT License."), ("a/LICENSE", "Licensed under the Apache License, Version 2.0."),
    ("a/b/c/code.py", "some code here\nand more of it"), ("a/x.py", "import things"),
    ("z/y.py", "x = 1\nThis work is licensed under the GNU General Public License, version 3.\ny = 2"),
    ("z/v2.py", "# This work is licensed under the GNU General Public License, version 2."),
    ("z/q.py", "the of and to public in version"), ("z/long.py", "word " * 500 + "\nLicensed under CC BY-NC 4.0.\n"),
    (None, "Licensed under CC BY-SA 4.0."), (None, "nothing"), ("e/empty", ""), ("e/null", None),
    ("top.py", "code"), ("d/one", "Licensed under CC BY 4.0."), ("d/two", "Licensed under the ISC License."), ("d/three", "code"),
]


def test_against_brute_force(spark):
    out = L.scan(files(spark, ROWS)).orderBy("file_id").collect()
    assert [(r.license, r.origin) for r in out] == brute(ROWS)


def test_whole_table_by_lines(spark):
    """Exactly the lines that state a licence are found in the documents."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = L.scan(docs.select(F.col("doc_id").alias("file_id"), F.lit("a/b").alias("path"), "text")).where("origin = 'header'")
    want = docs.where("lower(text) rlike '(?m)^(this work is |)(licensed|released) under'")
    assert {r.file_id for r in out.collect()} == {r.doc_id for r in want.collect()}


def test_odd_rows(spark):
    def as_files(docs):
        return docs.withColumn("file_id", F.col("doc_id")).withColumn("path", F.col("source"))
    assert L.scan(as_files(documents(spark))).count() == 14
    assert L.scan(as_files(empty(spark))).collect() == []


MIT_TEXT = dict((len(text), text) for name, text in L.TEMPLATES if name == "MIT")
MIT_TEXT = MIT_TEXT[max(MIT_TEXT)]
CODE = ["def add(a, b):", "    return a + b", "", "class Basket:", "    items = []"]


def wrapped(text, mark="", width=9):
    words = text.split()
    return [mark + " ".join(words[i:i + width]) for i in range(0, len(words), width)]


def header(name, occurrence=0, mark="# "):
    texts = sorted((t for n, t in L.TEMPLATES if n == name), key=lambda t: -len(t))
    return wrapped(texts[occurrence], mark)


def by_path(spark, rows):
    return {r.path: r for r in L.scan(files(spark, [(p, "\n".join(t)) for p, t in rows])).collect()}


def test_full_texts_headers_and_identifiers(spark):
    """Texts wrapped over lines behind comment marks; versions of a family are told apart."""
    rows = [(f"{name}/code.py", header(name) + CODE * 20)
            for name in ("GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "AGPL-3.0", "Apache-2.0", "MPL-2.0", "BSD-3-Clause",
                         "BSD-2-Clause", "ISC", "MIT")]
    rows += [(f"spdx/{name}", ["// SPDX-License-Identifier: " + name] + CODE)
             for name in ("MIT", "GPL-3.0", "GPL-2.0", "Apache-2.0", "BSD-3-Clause")]
    rows += [("plain/code.py", CODE * 50), ("spdx/other", ["// SPDX-License-Identifier: Other-9.9"] + CODE)]
    out = by_path(spark, rows)
    for path, row in out.items():
        folder, name = path.split("/")
        want = {"spdx": name, "plain": None}.get(folder, folder)
        assert row.license == (None if name == "other" else want), (path, row)


def test_all_declared_licences(spark):
    text = header("MIT") + CODE + header("Apache-2.0") + CODE + ["SPDX-License-Identifier: ISC"]
    row = by_path(spark, [("a/both.py", text)])["a/both.py"]
    assert set(row.licenses.split(",")) == {"MIT", "Apache-2.0", "ISC"} and row.origin == "header"


def test_licence_files_are_inherited_from_ancestors(spark):
    """A text with a year and a name before it is a licence file; a long one is by its name."""
    long = ["GNU GENERAL PUBLIC LICENSE", "Version 3, 29 June 2007", ""] + ["some clause of many words"] * 300
    out = by_path(spark, [("a/LICENSE", ["MIT License", "", "Copyright (c) 2024 Some Body", ""] + wrapped(MIT_TEXT)),
                          ("a/b/c/code.py", CODE), ("a/x/COPYING", long), ("a/x/y/z/code.py", CODE),
                          ("q/notes.txt", long), ("q/code.py", CODE)])
    got = {p: (r.license, r.origin, r.from_directory) for p, r in out.items()}
    assert got["a/b/c/code.py"] == ("MIT", "inherited", "a")
    assert got["a/x/y/z/code.py"] == ("GPL-3.0", "inherited", "a/x")
    assert got["q/notes.txt"] == ("GPL-3.0", "header", None) and got["q/code.py"] == (None, "none", None)


def test_groups_of_lines_against_every_group():
    """The nearest group is found though only groups that open with a term of the template are tried."""
    known = {t for _, x in L.TEMPLATES for t in L.terms(x)}
    matcher = L.Matcher(L.TEMPLATES, dict.fromkeys(known, 2.0), 5.0)
    text = "\n".join(CODE + header("Apache-2.0") + ["x = 1"] + header("MPL-2.0", mark="* ") + CODE)
    lines = [L.terms(x) for x in text.split("\n")]
    every = [matcher.cosine(i, Counter(t for x in lines[a:b] for t in x))
             for a in range(len(lines)) for b in range(a + 1, len(lines) + 1) for i in range(len(L.TEMPLATES))
             if any(lines[a:b])]
    top, names = matcher.declared(text, L.terms(text), L.HEADER_CUT)
    assert abs(top - max(every)) < 1e-9 and names == ["Apache-2.0", "MPL-2.0"]


def test_defined_results_of_odd_rows(spark):
    rows = [(None, None), ("a/x", None), ("a/x", None), (None, "Released under the MIT License."), ("LICENSE", "")]
    out = [(r.path, r.license, r.origin, r.licenses) for r in L.scan(files(spark, rows)).orderBy("file_id").collect()]
    assert out == [(None, None, "none", None), ("a/x", None, "none", None), ("a/x", None, "none", None),
                   (None, "MIT", "header", "MIT"), ("LICENSE", None, "none", None)]
