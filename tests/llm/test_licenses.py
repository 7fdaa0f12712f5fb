from kcflow.llm.licenses import TEMPLATES, scan_licences

SCHEMA = "path string, text string, row string, file long, line long, licence string"


def scan(spark, rows, given=None):
    df = spark.createDataFrame([(p, t, "r", 1, 1, "l") for p, t in rows], SCHEMA).repartition(2)
    return [(r.row.path, r.licence, r.basis, r.source) for r in scan_licences(df, given=given).collect()]


LICENCE = TEMPLATES[0][1]


def test_lines_files_and_inheritance(worker_path):
    rows = [("a/LICENSE", "Preamble of some length in other words\nReleased under the MIT License."),
            ("a/x.py", "code\n" + LICENCE + "\nmore"), ("a/b/y.py", "no notice at all"),
            ("a/b/c/z.py", None), ("a/b/c/copying.txt", ""), ("q/COPYING", "All rights reserved"),
            ("q/r/s/deep.c", "under the sun of the version"), ("q/r/NOTICE", LICENCE.upper()),
            ("p/only.txt", "x"), ("top.txt", "text " * 20000), (None, "LICENSED UNDER CC BY-NC 4.0!"),
            ("ab/not-under-a.txt", "y"), ("a/b/y.py", "no notice at all")]
    got = scan(worker_path, rows)
    assert len(got) == len(rows)
    assert set(got) == {
        ("a/LICENSE", "MIT", "file", "a/LICENSE"), ("a/x.py", "Apache-2.0", "line", "a/x.py"),
        ("a/b/y.py", "MIT", "inherited", "a/LICENSE"),
        ("a/b/c/z.py", "MIT", "inherited", "a/LICENSE"),
        ("a/b/c/copying.txt", "MIT", "inherited", "a/LICENSE"),
        ("q/COPYING", "Proprietary", "file", "q/COPYING"),
        ("q/r/s/deep.c", "Apache-2.0", "inherited", "q/r/NOTICE"),
        ("q/r/NOTICE", "Apache-2.0", "file", "q/r/NOTICE"), ("p/only.txt", None, None, None),
        ("top.txt", None, None, None), (None, "CC-BY-NC-4.0", "file", None),
        ("ab/not-under-a.txt", None, None, None)}


def test_root_licence_and_ties(worker_path):
    rows = [("LICENSE", "Released under the MIT License."), ("x/y/z", "text"), ("w", None),
            ("x/b/LICENSE", LICENCE), ("x/b/COPYING", LICENCE), ("x/b/f", "")]
    got = {p: (licence, source) for p, licence, _, source in scan(worker_path, rows)}
    assert got["x/y/z"] == got["w"] == ("MIT", "LICENSE")
    assert got["x/b/f"] == ("Apache-2.0", "x/b/COPYING")


def test_own_templates_and_empty(worker_path):
    given = worker_path.createDataFrame([("Z", "zebra zone zero"), ("A", "zebra zone zero")],
                                        "licence string, text string")
    rows = [("a/f", "Zebra, zone: ZERO."), ("a/g", "zebra crossing of many other words")]
    assert set(scan(worker_path, rows, given)) == {("a/f", "A", "file", "a/f"),
                                                   ("a/g", "A", "inherited", "a/f")}
    assert set(scan(worker_path, rows, given.limit(0))) == {("a/f", None, None, None),
                                                            ("a/g", None, None, None)}
    assert scan_licences(worker_path.createDataFrame([], SCHEMA)).collect() == []
