"""Multi-line CSV files cut into blocks at their true record ends."""

import csv
import io as pyio

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from quire.sources import csv_blocks as cb
from quire.sources import io

from support import rows

FIELD = st.text(st.sampled_from(list('a"\n,\u00e9 ')), max_size=6)


def _text(table, end="\n"):
    out = pyio.StringIO()
    csv.writer(out, lineterminator=end, quoting=csv.QUOTE_ALL).writerows(table)
    return out.getvalue()


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(FIELD, min_size=2, max_size=2), max_size=6), st.integers(1, 12),
       st.integers(1, 5), st.booleans())
def test_blocks_give_each_record_once(table, block, piece, cut_end):
    data = _text(table).encode()
    data = data[:-1] if cut_end else data
    got, quotes, before = [], 0, 0
    for start in range(0, len(data), block):
        counted, outer, inner = cb.block_counts(data[start:start + block])
        inside = quotes % 2 == 1
        got += [(before + k, r) for k, r in cb.block_records(
            pyio.BytesIO(data), start, block, inside, piece)]
        quotes, before = quotes + counted, before + (inner if inside else outer)
    assert [k for k, _ in got] == list(range(len(table)))
    assert [next(csv.reader(pyio.StringIO(r.decode(), newline=""))) for _, r in got] == table


SCHEMA = T.StructType([T.StructField("_c0", T.StringType()), T.StructField("qid", T.StringType()),
                       T.StructField("question", T.StringType()), T.StructField("n", T.DoubleType())])
HEAD = ",qid,question,n\n"
BODY = ('0,0008-0,"He said ""hi""\nthen, left\\nok",8.85\n'
        '1,0008-1,plain,\n'
        '2,0008-2,"",1\n'
        '\n'
        '3,0008-3," \n\n\u00fc""\n",2\n'
        '4,"0008-4", spaced ,3')


@pytest.mark.parametrize("block", [1, 5, 16, 1 << 20])
def test_blocks_read_like_one_task(spark, tmp_path, block):
    (tmp_path / "b.csv").write_text(HEAD + BODY, encoding="utf-8")
    (tmp_path / "a.csv").write_text(HEAD + '9,x,"\n\n",\n', encoding="utf-8")
    (tmp_path / "c.csv").write_text("")
    (tmp_path / "d.csv").write_text(HEAD)
    path = str(tmp_path)
    want = sorted(rows(io.read_questions_csv(spark, path, SCHEMA), "qid", "question", "n", "pos"),
                  key=lambda r: r[-1])
    got = sorted(rows(cb.read_csv(spark, path, SCHEMA, block=block), "qid", "question", "n", "pos"),
                 key=lambda r: r[-1])
    assert [r[:-1] for r in got] == [r[:-1] for r in want] and len(got) == 6


def test_one_file_is_read_by_several_tasks(spark, tmp_path):
    path = str(tmp_path / "big.csv")
    with open(path, "w", encoding="utf-8", newline="") as f:
        f.write(HEAD + "".join(f'{i},q{i},"line ""{i}""\nmore, {"x" * (i % 50)}\n",{i}\n'
                               for i in range(5000)))
    df = cb.read_csv(spark, path, SCHEMA, block=4096)
    assert len(set(df.select("qid").rdd.mapPartitionsWithIndex(
        lambda i, part: [i] if any(True for _ in part) else []).collect())) > 1
    one = io.read_questions_csv(spark, path, SCHEMA)
    assert sorted(rows(df, "pos", "qid", "question", "n")) == [
        (k + 1, *r) for k, r in enumerate(rows(one.orderBy("pos"), "qid", "question", "n"))]


def test_quotes_that_do_not_pair_up_fail(spark, tmp_path):
    (tmp_path / "a.csv").write_text(HEAD + '1,"x,y,2\n')
    with pytest.raises(Exception, match="a.csv: quotes do not pair up"):
        cb.read_csv(spark, str(tmp_path), SCHEMA, block=4).collect()
