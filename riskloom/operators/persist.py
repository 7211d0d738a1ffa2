"""What our own pipeline stages need to be saved and loaded with ``PipelineModel``."""

from __future__ import annotations

from pyspark.ml.param import Param, Params
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable


class Stored(DefaultParamsReadable, DefaultParamsWritable):
    """A stage whose parameters are all that it is."""


class Fitted(Stored, Params):
    """A fitted stage; what it learnt is the parameter ``state`` (values that JSON has)."""

    state = Param(Params._dummy(), "state", "what the fit learnt")

    def learnt(self):
        return self.getOrDefault(self.state)
