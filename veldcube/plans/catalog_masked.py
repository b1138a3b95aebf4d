"""Products and grids over masked cells: the registered builders over the cells inside the area polygons."""

from __future__ import annotations

from veldcube.plans.cube import MaskedCube
from veldcube.plans.oracle import CTE
from veldcube.plans.registry import over

CELL = "row_idx, col_idx"
TABLES = {
    "cells_all": CTE["cells"],
    "cells": f"SELECT * FROM cells_all SEMI JOIN (SELECT {CELL} FROM inside WHERE layer = 'aoi') USING ({CELL})",
    "burns_all": CTE["burns"],
    "burns": f"""SELECT aoi, sensor, resolution, year, month, {CELL}, CASE WHEN layer IS NOT NULL THEN burn_date ELSE 0 END AS burn_date
FROM burns_all LEFT JOIN (SELECT * FROM inside WHERE layer = 'aoi') USING ({CELL})""",
    "class_cells": f"SELECT {CELL}, layer AS land_cover FROM inside WHERE layer <> 'aoi'",
}

for base in (
    "a1_ndvi_monthly", "a2_ndvi_monthly_baselines", "a3_ndvi_annual", "a7_ndvi_monthly_by_class", "a9_ba_monthly",
    "b13_ndvi_annual_delta", "b14_burn_count", "q9_annual_grid", "q11_monthly_anomaly_grid", "q15_ba_monthly_grid",
    "q16_ba_annual_grid", "q16_ba_annual_totals",
):
    over(f"{base}_masked", base, MaskedCube, **TABLES)
