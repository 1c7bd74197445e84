"""The fixed grid that cuts an area into cells and cells into pixels."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Layout:
    """An extent cut into ``cols`` x ``rows`` cells of ``tile_cols`` x ``tile_rows`` pixels.

    Cell (0, 0) is the upper-left one. Methods that take a cell return Column expressions,
    so they run inside the plan.
    """

    xmin: float
    ymin: float
    xmax: float
    ymax: float
    cols: int
    rows: int
    tile_cols: int
    tile_rows: int

    @property
    def pixel_width(self) -> float:
        return abs(self.xmax - self.xmin) / (self.cols * self.tile_cols)

    @property
    def pixel_height(self) -> float:
        return abs(self.ymax - self.ymin) / (self.rows * self.tile_rows)

    @property
    def tile_size(self) -> int:
        return self.tile_cols * self.tile_rows

    def with_tile(self, tile_cols: int, tile_rows: int) -> Layout:
        return replace(self, tile_cols=tile_cols, tile_rows=tile_rows)

    def coarsen(self, factor: int) -> Layout:
        """The same pixels in cells ``factor`` times as wide and high."""
        if self.cols % factor or self.rows % factor:
            raise ValueError(f"{self.cols}x{self.rows} cells cannot be grouped by {factor}")
        return replace(
            self,
            cols=self.cols // factor,
            rows=self.rows // factor,
            tile_cols=self.tile_cols * factor,
            tile_rows=self.tile_rows * factor,
        )

    def contains(self, col: str = "col", row: str = "row") -> Column:
        """Whether a cell key lies on the grid (upper bounds exclusive)."""
        c, r = F.col(col), F.col(row)
        return (c >= 0) & (c < self.cols) & (r >= 0) & (r < self.rows)

    def extent(self, buffer: int = 0, col: str = "col", row: str = "row") -> dict[str, Column]:
        """Bounds of a cell, grown by ``buffer`` pixels on every side."""
        width = (self.xmax - self.xmin) / self.cols
        height = (self.ymax - self.ymin) / self.rows
        left = F.lit(self.xmin) + F.col(col) * F.lit(width)
        bottom = F.lit(self.ymax) - (F.col(row) + 1) * F.lit(height)
        dx, dy = buffer * self.pixel_width, buffer * self.pixel_height
        return {
            "xmin": left - F.lit(dx),
            "ymin": bottom - F.lit(dy),
            "xmax": left + F.lit(width) + F.lit(dx),
            "ymax": bottom + F.lit(height) + F.lit(dy),
        }

    def cell_of(self, gx: str = "gx", gy: str = "gy") -> dict[str, Column]:
        """Cell key and in-tile index of a global pixel position."""
        x, y = F.col(gx), F.col(gy)
        return {
            "col": F.floor(x / F.lit(self.tile_cols)).cast("bigint"),
            "row": F.floor(y / F.lit(self.tile_rows)).cast("bigint"),
            "column_index": F.pmod(x, F.lit(self.tile_cols)).cast("int"),
            "row_index": F.pmod(y, F.lit(self.tile_rows)).cast("int"),
        }

    def global_pixel(self) -> dict[str, Column]:
        """Inverse of :meth:`cell_of` for pixel-form rows."""
        return {
            "gx": F.col("col") * self.tile_cols + F.col("column_index"),
            "gy": F.col("row") * self.tile_rows + F.col("row_index"),
        }


# The master grid in longitude/latitude, 0.005 degree cells of 200 x 200 pixels.
MASTER = Layout(
    xmin=-17.541, ymin=-35.46, xmax=51.459, ymax=37.54,
    cols=13800, rows=14600, tile_cols=200, tile_rows=200,
)


@dataclass(frozen=True)
class SourceGrid:
    """Where target pixels fall on the pixel grid of the stored imagery.

    Target pixel ``t`` has its centre at source index ``scale * t + offset`` (source pixel
    ``i`` has its centre at index ``i``), separately along x and y. The default says that
    imagery is already stored on the layout's own pixels.
    """

    scale_x: float = 1.0
    offset_x: float = 0.0
    scale_y: float = 1.0
    offset_y: float = 0.0

    @classmethod
    def from_transform(
        cls, layout: Layout, xmin: float, ymax: float, pixel_width: float, pixel_height: float
    ) -> SourceGrid:
        """Build from the upper-left corner and pixel size of north-up source imagery."""
        return cls(
            scale_x=layout.pixel_width / pixel_width,
            offset_x=(layout.xmin + layout.pixel_width / 2 - xmin) / pixel_width - 0.5,
            scale_y=layout.pixel_height / pixel_height,
            offset_y=(ymax - layout.ymax + layout.pixel_height / 2) / pixel_height - 0.5,
        )

    @property
    def aligned(self) -> bool:
        return self == SourceGrid()
