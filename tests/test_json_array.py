"""JSON-array files read item by item."""

import io as pyio
import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from quire.sources import io
from quire.sources import json_array as ja

from support import rows

SCHEMA = T.StructType([T.StructField("qid", T.StringType()), T.StructField("n", T.LongType())])
VALUES = st.recursive(
    st.none() | st.booleans() | st.integers() | st.floats(allow_nan=False, allow_infinity=False)
    | st.text(st.characters(exclude_categories=["Cs"])),
    lambda inner: st.lists(inner, max_size=3) | st.dictionaries(st.text(max_size=3), inner, max_size=3),
    max_leaves=6)


def _walk(text, piece):
    return list(ja.array_items(pyio.BytesIO(text.encode("utf-8", "surrogatepass")).read, piece))


@settings(max_examples=150, deadline=None)
@given(st.lists(VALUES, max_size=5), st.integers(1, 9), st.sampled_from([None, 2]), st.booleans())
def test_items_are_those_of_the_whole_array(values, piece, indent, ascii_only):
    text = json.dumps(values, indent=indent, ensure_ascii=ascii_only)
    for whole in (text, "\ufeff \n" + text + " \n"):
        got = _walk(whole, piece)
        assert [json.loads(item) for item, _ in got] == values
        assert [o for _, o in got] == [isinstance(v, dict) for v in values]


@pytest.mark.parametrize("text", ["", " ", "{}", "5", "[", "[1", "[1,", "[1,]", "[1 2]", "[1] 2",
                                  "[,1]", "[{]", '["a', "[" * 100_000])
def test_what_is_no_array_is_an_error(text):
    for piece in (1, 7, 1 << 20):
        with pytest.raises(ValueError):
            _walk(text, piece)


def test_a_task_holds_an_item_and_a_piece():
    """A long file costs the memory of its items, not its own."""
    class Endless:
        given = 0

        def read(self, n):
            self.given += n
            return (b"[" if self.given == n else b"") + b'{"qid": "1"},' * (n // 13)

    source = Endless()
    items = ja.array_items(source.read, 1300)
    for _ in range(10_000):
        assert next(items) == ('{"qid": "1"}', True)
    assert source.given < 10_300 * 13
    with pytest.raises(ValueError, match="over 5000 characters"):
        list(ja.array_items(pyio.BytesIO(b'["' + b"x" * 100_000).read, 1000, 5000))


def test_rejects_have_a_place_and_a_reason(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"qid": "1", "n": 2}, 5, {"qid": "2", "n": "x"}, null, []]')
    (tmp_path / "b.json").write_text("[]")
    (tmp_path / "c.json").write_text('[{"qid": "3", "more": 1}]')
    path = str(tmp_path)
    assert sorted(rows(io.read_json_array(spark, path, SCHEMA))) == [("1", 2), ("3", None)]
    got = [(f.rsplit("/", 1)[1], *rest) for f, *rest in rows(ja.rejects(spark, path, SCHEMA))]
    assert sorted(got) == [("a.json", 1, "5", "not an object"),
                           ("a.json", 2, '{"qid": "2", "n": "x"}', "wrong type"),
                           ("a.json", 3, "null", "not an object"),
                           ("a.json", 4, "[]", "not an object")]
    (tmp_path / "d.json").write_text('{"qid": "1"}')
    with pytest.raises(Exception, match="d.json: not a JSON array"):
        io.read_json_array(spark, path, SCHEMA).collect()
    with pytest.raises(ValueError, match="missing columns"):
        io.read_json_array(spark, path, T.StructType([SCHEMA["n"]]))


@pytest.mark.parametrize("piece", [1, 2, 3, 4])
def test_numbers_cut_at_their_fraction_or_exponent(piece):
    text = "[0.0, -1.5e+30, 2E-7 ,1e5]"
    assert [item for item, _ in _walk(text, piece)] == ["0.0", "-1.5e+30", "2E-7", "1e5"]
    for wrong in ("[1.]", "[1.,2]", "[1e+]", "[1 .5]"):
        with pytest.raises(ValueError):
            _walk(wrong, piece)
