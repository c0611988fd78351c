"""Lodestone: evidence-grounded record analytics and corpus operators on Spark."""

from __future__ import annotations

import atexit
import io
import os
import tempfile
import zipfile
from pathlib import Path

_shipped: set[str] = set()


def ship(spark) -> None:
    """Sends this package's modules to the executors of ``spark``, once for each application."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = Path(__file__).resolve().parent
    held = io.BytesIO()
    with zipfile.ZipFile(held, "w") as out:
        for path in sorted(root.rglob("*.py")):
            out.write(path, f"{root.name}/{path.relative_to(root)}")
    handle, name = tempfile.mkstemp(prefix="lodestone-", suffix=".zip")
    with os.fdopen(handle, "wb") as out:
        out.write(held.getvalue())
    atexit.register(Path(name).unlink, missing_ok=True)  # the driver serves it to executors until then
    spark.sparkContext.addPyFile(name)
    _shipped.add(app)
