"""Text to vector: a TF-IDF embedder from Spark ML, or a plug-in model."""

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import IDF, HashingTF, Normalizer, RegexTokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fit_tfidf(df: DataFrame, text: str, dims: int = 256) -> PipelineModel:
    """Hashed TF-IDF with unit length.  The fit is one pass that adds up `dims` document counts."""
    return Pipeline(
        stages=[
            RegexTokenizer(inputCol=text, outputCol="__words", pattern=r"[^\p{L}\p{N}]+"),
            HashingTF(inputCol="__words", outputCol="__tf", numFeatures=dims),
            IDF(inputCol="__tf", outputCol="__tfidf"),
            Normalizer(inputCol="__tfidf", outputCol="__unit"),
        ]
    ).fit(df.select(text))


def embed_tfidf(df: DataFrame, model: PipelineModel, out: str = "vector") -> DataFrame:
    embedded = model.transform(df)
    return embedded.withColumn(out, vector_to_array("__unit", "float32")).drop(
        "__words", "__tf", "__tfidf", "__unit"
    )


def embed_with_model(
    df: DataFrame, text: str, vectors_of: Callable[[pd.Series], list], out: str = "vector"
) -> DataFrame:
    """Embed with a plug-in: a callable from a batch of texts to a list of vectors."""

    @F.pandas_udf("array<float>")
    def embed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([list(map(float, v)) for v in vectors_of(batch)])

    return df.withColumn(out, embed(text))
