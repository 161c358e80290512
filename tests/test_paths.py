"""F9/F10/F12 against a plain-Python statement of the documented
behaviour, on generated URIs (valid percent escapes only: a malformed
escape is a documented difference)."""

import posixpath
import re
import urllib.parse

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lookout.functions.paths import base_name, file_suffix, to_local_path, with_local_path

ROOT = "/app"


def expected_local(uri):
    """Unquote, drop a ``file:`` scheme, one leading slash, drive letter to
    its WSL mount, relative under ROOT, backslashes to slashes."""
    if uri is None:
        return None
    p = urllib.parse.unquote(uri)
    p = p[len("file:"):] if p.startswith("file:") else p
    p = re.sub(r"^/+", "/", p)
    m = re.match(r"^([A-Za-z]):/", p)
    if m:
        p = "/mnt/" + m.group(1).lower() + "/" + p[3:]
    if not p.startswith("/"):
        p = posixpath.join(ROOT, p)
    return p.replace("\\", "/")


def expected_suffix(path):
    name = path.rsplit("/", 1)[-1]
    i = name.rfind(".")
    return name[i:].lower() if 0 < i < len(name) - 1 else ""


pieces = st.sampled_from(
    ["file:", "/", "//", "C:/", "c:/", "d:/", "Z:/", "\\", "%20", "%2B", "+", "%25", "%C3%A9", "a", "B", ".", ".png",
     ".JPG", "x.y", "data", " ", ":", "é"]
)
uris = st.lists(pieces, min_size=0, max_size=8).map("".join)


@settings(max_examples=2, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(uris, min_size=300, max_size=300))
def test_local_path_matches_spec(spark, values):
    values = values + [None, "", "file:///mnt/c/data%20set/click+1.jpg", "C:/x/y.PNG", "data\\a b.Jpeg", ".bashrc"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, uri string")
    staged = with_local_path(df, "uri", "lp", ROOT).select("i", "lp", base_name(F.col("lp")).alias("b"),
                                                          file_suffix(F.col("lp")).alias("s"))
    inline = df.select("i", to_local_path(F.col("uri"), ROOT).alias("lp2"))
    got = {r.i: (r.lp, r.b, r.s) for r in staged.collect()}
    got2 = {r.i: r.lp2 for r in inline.collect()}
    for i, v in enumerate(values):
        want = expected_local(v)
        assert got[i][0] == want, (v, got[i][0], want)
        assert got2[i] == want
        if want is not None:
            assert got[i][1] == want.rsplit("/", 1)[-1]
            assert got[i][2] == expected_suffix(want), (want, got[i][2])


def test_windows_branch(spark):
    cases = {
        "file:///mnt/c/data%20set/a.jpg": "C:\\data set\\a.jpg",
        "/d/shots/x.png": "d:\\shots\\x.png",
        "/var/img/x.png": "\\var\\img\\x.png",
        "rel/x.png": "C:\\proj\\rel\\x.png",
        "E:/already/there.bmp": "E:\\already\\there.bmp",
    }
    df = spark.createDataFrame([(k,) for k in cases], "uri string")
    got = {r.uri: r.lp for r in df.select("uri", to_local_path(F.col("uri"), "C:\\proj", windows=True).alias("lp")).collect()}
    assert got == cases
