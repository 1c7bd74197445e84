"""Active learning on gridded imagery, written as ordinary Spark DataFrame jobs.

Vocabulary used throughout the package:

* a *cell* is one square of the layout grid, named by the integers ``col`` and ``row``;
* the *tile form* has one row per cell (and season, scene) with one array column per band,
  row-major, nodata as NULL;
* the *pixel form* has one row per pixel: ``col, row, column_index, row_index`` and one
  column per value.
"""

from tilecast.layout import MASTER, Layout, SourceGrid

__all__ = ["MASTER", "Layout", "SourceGrid"]
