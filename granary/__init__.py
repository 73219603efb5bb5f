"""Dataset curation on Spark: DataFrame-to-DataFrame operators for inventories, labels, duplicates, boxes, splits and reports."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path


def ship(spark) -> None:
    """Send this package's code to the executors, once a context: they need not have it on their path.

    The archive is made on the driver, and Spark hands it to each executor that needs it, also to later ones.
    """
    sc = spark.sparkContext
    if getattr(sc, "_granary_shipped", False):
        return
    root, target = Path(__file__).resolve().parent, Path(tempfile.mkdtemp()) / "granary.zip"
    with zipfile.ZipFile(target, "w") as archive:
        for path in sorted(root.rglob("*.py")):
            archive.write(path, path.relative_to(root.parent))
    sc.addPyFile(str(target))
    sc._granary_shipped = True
