"""What the tests share: the driver's tables and how rows are read."""

import os

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


def rows(df, *cols):
    """Rows as plain tuples (in the frame's order)."""
    sel = df.select(*cols) if cols else df
    return [tuple(r) for r in sel.collect()]
