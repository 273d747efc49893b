"""Feature stages for Spark ML pipelines.

An extractor is an estimator whose fitted form is a pipeline of row-wise
stages, so it applies to a batch or a stream alike and is saved and loaded with
Spark's own writers.
"""

from __future__ import annotations

import importlib

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel, Transformer
from pyspark.ml.feature import (
    CountVectorizerModel,
    ElementwiseProduct,
    Normalizer,
    RegexTokenizer,
)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.ml.util import (
    DefaultParamsReadable,
    DefaultParamsReader,
    DefaultParamsWritable,
    DefaultParamsWriter,
    MLReadable,
    MLReader,
    MLWritable,
    MLWriter,
)
from pyspark.sql import functions as F

import numpy as np
import pyarrow as pa

from lexiform.cluster import checkpointed
from lexiform.functions.stop_words import ENGLISH
from lexiform.functions.text import (
    WORD_PATTERN,
    join_text,
    strip_accents,
    tokenize_whitespace,
    tokenize_words,
)
from lexiform.functions.vectors import as_array, bound, l2_normalize
from lexiform.operators.columns import assemble_features, chosen_columns
from lexiform.operators.embed import embed_text, embed_text_batched
from lexiform.operators.pooling import TRAINING_PARTITIONS, train_in_parts
from lexiform.operators.scale import feature_moments, standardized
from lexiform.operators.skipgram import SkipGram
from lexiform.operators.terms import encoded, numbered_terms, sparse_vectors, weighed
from lexiform.operators.vectorize import idf, term_statistics, vocabulary, vocabulary_lists

TEXT, TOKENS, COUNTS, POOLED = "_text", "_tokens", "_counts", "_pooled"


class _Saved(DefaultParamsReadable, DefaultParamsWritable):
    """Stages that consist of their parameters."""


class TextColumn(Transformer, HasOutputCol, _Saved):
    """One text from the columns that match the include and exclude patterns."""

    include = Param(Params._dummy(), "include", "column patterns", TypeConverters.toListString)
    exclude = Param(Params._dummy(), "exclude", "column patterns", TypeConverters.toListString)
    accents = Param(Params._dummy(), "accents", "keep accents", TypeConverters.toBoolean)

    @keyword_only
    def __init__(self, include=("text",), exclude=(), accents=True, outputCol=TEXT):
        super().__init__()
        self._set(include=list(include), exclude=list(exclude), accents=accents, outputCol=outputCol)

    def _transform(self, dataset):
        include, exclude = self.getOrDefault("include"), self.getOrDefault("exclude")
        text = join_text(chosen_columns(dataset.columns, include, exclude))
        if not self.getOrDefault("accents"):
            text = strip_accents(text)
        return dataset.withColumn(self.getOutputCol(), text)


class WhitespaceTokens(Transformer, HasInputCol, HasOutputCol, _Saved):
    """Lower-case white-space tokens."""

    @keyword_only
    def __init__(self, inputCol=TEXT, outputCol=TOKENS):
        super().__init__()
        self._set(inputCol=inputCol, outputCol=outputCol)

    def _transform(self, dataset):
        return dataset.withColumn(self.getOutputCol(), tokenize_whitespace(self.getInputCol()))


class DropColumns(Transformer, _Saved):
    """Remove working columns."""

    columns = Param(Params._dummy(), "columns", "columns to drop", TypeConverters.toListString)

    @keyword_only
    def __init__(self, columns=()):
        super().__init__()
        self._set(columns=list(columns))

    def _transform(self, dataset):
        return dataset.drop(*self.getOrDefault("columns"))


@F.arrow_udf(VectorUDT())
def _dampened(vectors: pa.Array) -> pa.Array:
    values = vectors.field("values")
    counts = np.asarray(values.values)
    done = np.where(counts > 0, 1.0 + np.log(np.maximum(counts, 1e-300)), 0.0)
    fields = {f.name: vectors.field(f.name) for f in vectors.type}
    fields["values"] = pa.ListArray.from_arrays(values.offsets, pa.array(done), mask=values.is_null())
    return pa.StructArray.from_arrays(list(fields.values()), list(fields), mask=vectors.is_null())


class SublinearCounts(Transformer, HasInputCol, HasOutputCol, _Saved):
    """Counts as 1 + ln(count)."""

    @keyword_only
    def __init__(self, inputCol=COUNTS, outputCol=COUNTS):
        super().__init__()
        self._set(inputCol=inputCol, outputCol=outputCol)

    def _transform(self, dataset):
        return dataset.withColumn(self.getOutputCol(), _dampened(F.unwrap_udt(self.getInputCol())))


class MeanOverKnownWords(Transformer, HasInputCol, HasOutputCol, _Saved):
    """Turn a mean over all tokens into a mean over the tokens in the vocabulary."""

    @keyword_only
    def __init__(self, inputCol=POOLED, outputCol="features"):
        super().__init__()
        self._set(inputCol=inputCol, outputCol=outputCol)

    def _transform(self, dataset):
        counts = F.unwrap_udt(COUNTS)["values"]
        known = F.aggregate(counts, F.lit(0.0), lambda acc, x: acc + x)
        factor = F.size(TOKENS) / F.greatest(known, F.lit(1.0))
        pooled = vector_to_array(self.getInputCol())
        mean = bound(factor, lambda f: F.transform(pooled, lambda x: x * f))
        return dataset.withColumn(self.getOutputCol(), array_to_vector(mean))


class Projection(Transformer, HasOutputCol, _Saved):
    """An existing numeric column, array or vector as the feature vector."""

    column = Param(Params._dummy(), "column", "source column", TypeConverters.toString)

    @keyword_only
    def __init__(self, column="embedding", outputCol="features"):
        super().__init__()
        self._set(column=column, outputCol=outputCol)

    def _transform(self, dataset):
        array = as_array(dataset, self.getOrDefault("column"))
        return dataset.withColumn(self.getOutputCol(), array_to_vector(array))


class NumericColumns(Transformer, HasOutputCol, _Saved):
    """The numeric columns that match the patterns as the feature vector."""

    include = Param(Params._dummy(), "include", "column patterns", TypeConverters.toListString)
    exclude = Param(Params._dummy(), "exclude", "column patterns", TypeConverters.toListString)

    @keyword_only
    def __init__(self, include=("*",), exclude=("doc_id", "target", "label", "weight"),
                 outputCol="features"):
        super().__init__()
        self._set(include=list(include), exclude=list(exclude), outputCol=outputCol)

    def _transform(self, dataset):
        get = self.getOrDefault
        return assemble_features(dataset, get("include"), get("exclude"), self.getOutputCol())


class _Extractor(Estimator, HasOutputCol, _Saved):
    include = Param(Params._dummy(), "include", "column patterns", TypeConverters.toListString)
    exclude = Param(Params._dummy(), "exclude", "column patterns", TypeConverters.toListString)


class TermFeatures(_Extractor):
    """Token counts or TF-IDF weights over a vocabulary fitted on the training text.

    With ``maxFeatures`` None all terms within the bounds count; they stay a table, and applying the
    fitted stage is a join by the row id.
    """

    maxFeatures = Param(Params._dummy(), "maxFeatures", "vocabulary size", TypeConverters.toInt)
    minDF = Param(Params._dummy(), "minDF", "lowest document frequency")
    maxDF = Param(Params._dummy(), "maxDF", "highest document frequency")
    stopWords = Param(Params._dummy(), "stopWords", "words left out", TypeConverters.toListString)
    tfidf = Param(Params._dummy(), "tfidf", "weigh and normalise", TypeConverters.toBoolean)
    useIdf = Param(Params._dummy(), "useIdf", "weigh by idf", TypeConverters.toBoolean)
    smoothIdf = Param(Params._dummy(), "smoothIdf", "smooth idf", TypeConverters.toBoolean)
    sublinearTf = Param(Params._dummy(), "sublinearTf", "1 + ln(tf)", TypeConverters.toBoolean)
    accents = Param(Params._dummy(), "accents", "keep accents", TypeConverters.toBoolean)
    identifier = Param(Params._dummy(), "identifier", "row id", TypeConverters.toString)

    @keyword_only
    def __init__(self, include=("text",), exclude=(), outputCol="features", maxFeatures=10_000,
                 minDF=1, maxDF=1.0, stopWords=tuple(ENGLISH), tfidf=False, useIdf=True,
                 smoothIdf=True, sublinearTf=False, accents=True, identifier="doc_id"):
        super().__init__()
        given = dict(self._input_kwargs)
        defaults = dict(
            include=include, exclude=exclude, outputCol=outputCol, maxFeatures=maxFeatures,
            minDF=minDF, maxDF=maxDF, stopWords=stopWords, tfidf=tfidf, useIdf=useIdf,
            smoothIdf=smoothIdf, sublinearTf=sublinearTf, accents=accents, identifier=identifier,
        )
        values = {**defaults, **given}
        for name in ("include", "exclude", "stopWords"):
            values[name] = list(values[name])
        self._set(**values)

    # Statistics of the training frame and its number of rows, if at hand.
    statistics = None

    def term_statistics(self, dataset):
        """Frequencies of all terms of a frame, which serve any bounds on them."""
        get = self.getOrDefault
        text = TextColumn(include=get("include"), exclude=get("exclude"), accents=get("accents"))
        return term_statistics(
            text.transform(dataset), tokenize_words(TEXT), get("stopWords")
        )

    def _fit(self, dataset):
        get, output = self.getOrDefault, self.getOutputCol()
        text = TextColumn(include=get("include"), exclude=get("exclude"), accents=get("accents"))
        counted = self.statistics
        if counted is None:
            counted = self.term_statistics(dataset), dataset.count()
        if get("maxFeatures") is None:
            return self._fit_all(*counted)
        chosen = vocabulary(
            *counted, max_features=get("maxFeatures"), min_df=get("minDF"), max_df=get("maxDF")
        )
        terms, weights = vocabulary_lists(chosen, use_idf=get("useIdf"), smooth_idf=get("smoothIdf"))
        counter = CountVectorizerModel.from_vocabulary(
            terms, inputCol=TOKENS, outputCol=COUNTS if get("tfidf") else output
        )
        stages = [
            text,
            RegexTokenizer(inputCol=TEXT, outputCol=TOKENS, pattern=WORD_PATTERN, gaps=False),
            counter,
        ]
        if get("tfidf"):
            if get("sublinearTf"):
                stages.append(SublinearCounts())
            weigh = ElementwiseProduct(scalingVec=Vectors.dense(weights), inputCol=COUNTS, outputCol="_weighed")
            stages += [weigh, Normalizer(p=2.0, inputCol="_weighed", outputCol=output)]
        return PipelineModel(stages + [DropColumns(columns=[TEXT, TOKENS, COUNTS, "_weighed"])])


    def _fit_all(self, statistics, n_docs):
        """All terms within the bounds, as a table."""
        get = self.getOrDefault
        terms = numbered_terms(statistics, n_docs, get("minDF"), get("maxDF"))
        weight = idf(use_idf=get("useIdf"), smooth_idf=get("smoothIdf"))
        text = TextColumn(include=get("include"), exclude=get("exclude"), accents=get("accents"))
        model = TermTableModel(
            tfidf=get("tfidf"), sublinearTf=get("sublinearTf"), identifier=get("identifier"),
            outputCol=self.getOutputCol(),
        )
        model.table = checkpointed(terms.select("term", "df", "index", weight.alias("idf")))
        if model.table.isEmpty():
            raise ValueError("no terms remain: relax min_df and max_df or the stop words")
        words = RegexTokenizer(inputCol=TEXT, outputCol=TOKENS, pattern=WORD_PATTERN, gaps=False)
        return PipelineModel([text, words, model, DropColumns(columns=[TEXT, TOKENS])])


class TableWriter(MLWriter):
    """Saves a model's parameters and the table that it holds."""

    def __init__(self, instance):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path):
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession)
        self.instance.table.write.mode("overwrite").parquet(f"{path}/table")


class TableReader(MLReader):
    """Loads what TableWriter saved."""

    def __init__(self, kind):
        super().__init__()
        self.kind = kind

    def load(self, path):
        model = self.kind()
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        DefaultParamsReader.getAndSetParams(model, metadata)
        model.table = self.sparkSession.read.parquet(f"{path}/table")
        return model


class TermTableModel(Model, HasOutputCol, MLReadable, MLWritable):
    """Fitted TermFeatures without a bound on the vocabulary. Needs a row id; batch only."""

    tfidf = TermFeatures.tfidf
    sublinearTf = TermFeatures.sublinearTf
    identifier = TermFeatures.identifier
    table = None

    @keyword_only
    def __init__(self, tfidf=False, sublinearTf=False, identifier="doc_id", outputCol="features"):
        super().__init__()
        self._set(tfidf=tfidf, sublinearTf=sublinearTf, identifier=identifier, outputCol=outputCol)

    def write(self):
        return TableWriter(self)

    @classmethod
    def read(cls):
        return TableReader(cls)

    def _transform(self, dataset):
        get, key, output = self.getOrDefault, self.getOrDefault("identifier"), self.getOutputCol()
        value = weighed(F.col("idf"), get("sublinearTf")) if get("tfidf") else F.col("tf")
        values = l2_normalize("values") if get("tfidf") else F.col("values")
        rows = encoded(dataset, self.table, key, TOKENS, value)
        rows = checkpointed(rows.select(key, "indices", values.alias("values")))
        vector = sparse_vectors(self.table.count())("indices", "values")
        return dataset.join(rows.select(key, vector.alias(output)), key, "left")


class WordVectors(_Extractor):
    """Documents as the mean of skip-gram vectors of their known words."""

    vectorSize = Param(Params._dummy(), "vectorSize", "dimensions", TypeConverters.toInt)
    window = Param(Params._dummy(), "window", "context size", TypeConverters.toInt)
    minCount = Param(Params._dummy(), "minCount", "lowest frequency", TypeConverters.toInt)
    epochs = Param(Params._dummy(), "epochs", "passes", TypeConverters.toInt)
    alpha = Param(Params._dummy(), "alpha", "learning rate", TypeConverters.toFloat)
    partitions = Param(Params._dummy(), "partitions", "training partitions", TypeConverters.toInt)
    seed = Param(Params._dummy(), "seed", "random seed", TypeConverters.toInt)

    @keyword_only
    def __init__(self, include=("text",), exclude=(), outputCol="features", vectorSize=100,
                 window=5, minCount=1, epochs=10, alpha=0.025,
                 partitions=TRAINING_PARTITIONS, seed=42):
        super().__init__()
        self._set(
            include=list(include), exclude=list(exclude), outputCol=outputCol,
            vectorSize=vectorSize, window=window, minCount=minCount, epochs=epochs, alpha=alpha,
            partitions=partitions, seed=seed,
        )

    def _fit(self, dataset):
        get = self.getOrDefault
        first = [TextColumn(include=get("include"), exclude=get("exclude")), WhitespaceTokens()]
        trainer = SkipGram(
            vectorSize=get("vectorSize"), windowSize=get("window"), minCount=get("minCount"),
            maxIter=get("epochs"), stepSize=get("alpha"), seed=get("seed"),
            numPartitions=get("partitions"), inputCol=TOKENS, outputCol=POOLED,
        )
        prepared = PipelineModel(first).transform(dataset).select(TOKENS)
        model = train_in_parts(trainer, prepared).as_stage()
        words = [row["word"] for row in model.getVectors().select("word").collect()]
        known = CountVectorizerModel.from_vocabulary(words, inputCol=TOKENS, outputCol=COUNTS)
        mean = MeanOverKnownWords(outputCol=self.getOutputCol())
        return PipelineModel(
            first + [model, known, mean, DropColumns(columns=[TEXT, TOKENS, COUNTS, POOLED])]
        )


class TextEncoder(_Extractor):
    """Dense embeddings by an encoder named as ``module:factory``.

    The name and its arguments are saved, never a credential: the factory has
    to find those in its own environment. ``batchSize`` 0 means whole batches
    and errors are raised; otherwise failed batches give zeros and embed_ok.
    """

    factory = Param(Params._dummy(), "factory", "module:function", TypeConverters.toString)
    size = Param(Params._dummy(), "size", "dimensions", TypeConverters.toInt)
    batchSize = Param(Params._dummy(), "batchSize", "texts per call", TypeConverters.toInt)
    pause = Param(Params._dummy(), "pause", "seconds between calls", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, include=("text",), exclude=(), outputCol="features",
                 factory="lexiform.operators.embed:hashing_encoder", size=64, batchSize=0,
                 pause=0.0):
        super().__init__()
        self._set(include=list(include), exclude=list(exclude), outputCol=outputCol,
                  factory=factory, size=size, batchSize=batchSize, pause=pause)

    def _fit(self, dataset):
        get = self.getOrDefault
        text = TextColumn(include=get("include"), exclude=get("exclude"))
        model = TextEncoderModel(
            factory=get("factory"), size=get("size"), batchSize=get("batchSize"),
            pause=get("pause"), outputCol=self.getOutputCol(),
        )
        return PipelineModel([text, model, DropColumns(columns=[TEXT])])


class TextEncoderModel(Model, HasOutputCol, _Saved):
    """The row-wise part of TextEncoder."""

    factory = TextEncoder.factory
    size = TextEncoder.size
    batchSize = TextEncoder.batchSize
    pause = TextEncoder.pause

    @keyword_only
    def __init__(self, factory="lexiform.operators.embed:hashing_encoder", size=64, batchSize=0,
                 pause=0.0, outputCol="features"):
        super().__init__()
        self._set(factory=factory, size=size, batchSize=batchSize, pause=pause, outputCol=outputCol)

    def _transform(self, dataset):
        get, output = self.getOrDefault, self.getOutputCol()
        module, name = get("factory").split(":")
        make, size = getattr(importlib.import_module(module), name), get("size")

        def encoder():
            return make(size)

        if get("batchSize"):
            done = embed_text_batched(
                dataset, encoder, size, get("batchSize"), get("pause"), TEXT, output
            )
        else:
            done = embed_text(dataset, encoder, TEXT, output)
        return done.withColumn(output, array_to_vector(output))


class PopulationScaler(Estimator, HasInputCol, HasOutputCol, _Saved):
    """Centre and scale by the population moments of the training frame.

    Features of more than ``denseWidth`` dimensions are scaled but not centred,
    so that sparse rows stay sparse.
    """

    denseWidth = Param(Params._dummy(), "denseWidth", "widest centred rows", TypeConverters.toInt)

    @keyword_only
    def __init__(self, inputCol="features", outputCol="scaled", denseWidth=2048):
        super().__init__()
        self._set(inputCol=inputCol, outputCol=outputCol, denseWidth=denseWidth)

    def _fit(self, dataset):
        mean, scale = feature_moments(dataset, self.getInputCol())
        if len(mean) > self.getOrDefault("denseWidth"):
            return ElementwiseProduct(
                scalingVec=Vectors.dense([1.0 / s for s in scale]),
                inputCol=self.getInputCol(), outputCol=self.getOutputCol(),
            )
        return PopulationScalerModel(
            mean=mean, scale=scale, inputCol=self.getInputCol(), outputCol=self.getOutputCol()
        )


class PopulationScalerModel(Model, HasInputCol, HasOutputCol, _Saved):
    """Fitted PopulationScaler."""

    mean = Param(Params._dummy(), "mean", "means", TypeConverters.toListFloat)
    scale = Param(Params._dummy(), "scale", "scales", TypeConverters.toListFloat)

    @keyword_only
    def __init__(self, mean=(), scale=(), inputCol="features", outputCol="scaled"):
        super().__init__()
        self._set(mean=list(mean), scale=list(scale), inputCol=inputCol, outputCol=outputCol)

    def _transform(self, dataset):
        array = as_array(dataset, self.getInputCol())
        done = standardized(array, self.getOrDefault("mean"), self.getOrDefault("scale"))
        return dataset.withColumn(self.getOutputCol(), array_to_vector(done))


def sequence_of(stages) -> Pipeline:
    """An ML pipeline of at least one stage."""
    if not stages:
        raise ValueError("at least one stage is needed")
    return Pipeline(stages=list(stages))
