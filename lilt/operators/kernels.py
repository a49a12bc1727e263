"""Frame operators whose steps depend on each other, so they run in Python over whole utterances."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lilt.functions import pitch


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def _repaired(tracks: pd.Series) -> pd.Series:
    fixed = (pitch.repair_local(np.array([np.nan if x is None else x for x in t], float)) for t in tracks)
    return pd.Series([[None if np.isnan(x) else float(x) for x in t] for t in fixed])


def octave_local(track: DataFrame) -> DataFrame:
    """(utt, frame, f0): voiced pitch moved by an octave towards its local median where that gains more than half an octave.

    An utterance's frames are gathered into one array, bounded by a recording's length. Unvoiced frames have a null pitch.
    """
    voiced = track.select("utt", F.struct("frame", F.when(F.col("voiced"), F.col("f0")).alias("f0")).alias("x"))
    gathered = voiced.groupBy("utt").agg(F.array_sort(F.collect_list("x")).alias("x"))
    fixed = gathered.select("utt", F.arrays_zip(F.col("x.frame").alias("frame"), _repaired("x.f0").alias("f0")).alias("y"))
    return fixed.select("utt", F.explode("y").alias("y")).select("utt", "y.frame", "y.f0")
