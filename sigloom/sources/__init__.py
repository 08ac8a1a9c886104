"""Readers of recording formats. register(spark) makes them available to spark.read.format(name).load(path)."""

from __future__ import annotations

from pyspark.sql import SparkSession

from sigloom.session import ship
from sigloom.sources import blackrock, edf, mef, mefmeta, mefrec, moberg, nex, nicolet, openephys, persyst, plain, spike2, tdms

FORMATS = (*plain.ALL, *edf.ALL, *openephys.ALL, *persyst.ALL, *blackrock.ALL, *moberg.ALL, *mef.ALL, *mefmeta.ALL, *mefrec.ALL, *nex.ALL, *nicolet.ALL, *tdms.ALL, *spike2.ALL)


def register(spark: SparkSession) -> list[str]:
    ship(spark)
    for f in FORMATS:
        spark.dataSource.register(f)
    return [f.NAME for f in FORMATS]
