"""Save and load a trained tokenizer.

A model is published as a whole: everything is written to a new folder
``versions/<name>/`` (``vocab/`` and ``merges/`` as parquet tables, and the files
``tokenizer.json`` / ``tokenizer_config.json`` in the usual exchange format:
vocabulary as printable form -> id in id order, merges as lines of two printable
forms in rank order), then ``manifest.json``, which names the folder and
the digests of its files, is put in place by one rename. Readers follow the
manifest and check the digests, so they see the old model or the new one; a writer
that dies midway leaves the old one. Copies of the two files for other tools
lie beside the manifest. The JSON is put together by Spark from the
vocabulary and merge tables, which are bounded by the vocabulary size.
Loading reads the JSON with an explicit schema and rebuilds merges with
equi-joins on the printable forms; a folder without a manifest is read as plain files.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tokenmill.constants import SPECIAL_TOKENS_19, SPECIAL_TOKENS_25, UNKNOWN
from tokenmill.functions.text import bytes_to_printable, is_printable_form, printable_to_bytes
from tokenmill.operators.train import BpeModel

TOKENIZER_SCHEMA = T.StructType([
    T.StructField("version", T.StringType()),
    T.StructField("model", T.StructType([
        T.StructField("type", T.StringType()),
        T.StructField("vocab", T.MapType(T.StringType(), T.IntegerType())),
        T.StructField("merges", T.ArrayType(T.StringType())),
    ])),
])
MANIFEST = "manifest.json"
MANIFEST_SCHEMA = "version string, files map<string, string>"
FILES = ("tokenizer_config.json", "tokenizer.json")
CONFIG_SCHEMA = "model_type string, vocab_size int, special_tokens array<string>, trained_on string, date string"

# fixed values: the parts of the file that do not depend on the model
FILE_FRAME = """named_struct(
  'version', '1.0',
  'model', named_struct('type', 'BPE', 'vocab', vocab, 'merges', merges,
                        'unk_token', cast({unk} as string), 'byte_fallback', {fallback}),
  'pre_tokenizer', named_struct('type', 'Sequence', 'pretokenizers', array(
      map('type', 'Digits', 'individual_digits', 'true'),
      map('type', 'ByteLevel', 'add_prefix_space', 'false', 'use_regex', 'true'))),
  'decoder', named_struct('type', 'ByteLevel', 'add_prefix_space', false),
  'post_processor', cast(null as string),
  'added_tokens', cast(array() as array<string>))"""


def printable_vocab(model: BpeModel, spark: SparkSession) -> DataFrame:
    """``(repr, id)``: specials by name, all else in printable form. Of entries
    with one form the largest id counts."""
    v = model.vocab_df(spark)
    form = F.when(F.col("kind") == "special", F.col("bytes").cast("string")).otherwise(bytes_to_printable("bytes"))
    return v.select(form.alias("repr"), "id").groupBy("repr").agg(F.max("id").alias("id"))


def tokenizer_document(model: BpeModel, spark: SparkSession) -> DataFrame:
    """One row, ``value``: the tokenizer file."""
    pairs = F.array_sort(F.collect_list(F.struct("id", "repr")))
    vocab = printable_vocab(model, spark).agg(
        F.map_from_entries(F.transform(pairs, lambda p: F.struct(p["repr"], p["id"]))).alias("vocab"))
    forms = model.vocab_df(spark).select("id", bytes_to_printable("bytes").alias("repr"))
    left = forms.withColumnsRenamed({"id": "left", "repr": "l"})
    right = forms.withColumnsRenamed({"id": "right", "repr": "r"})
    # the vocabulary is bounded by the model size: broadcast lookups
    lines = (model.merges_df(spark).join(F.broadcast(left), "left").join(F.broadcast(right), "right")
             .agg(F.array_sort(F.collect_list(F.struct("rank", F.concat_ws(" ", "l", "r").alias("line")))).alias("x"))
             .select(F.transform("x", lambda x: x["line"]).alias("merges")))
    whole = model.alphabet is None
    frame = FILE_FRAME.format(unk="null" if whole else f"'{UNKNOWN}'", fallback=str(whole).lower())
    return vocab.crossJoin(lines).select(      # one row each
        F.regexp_replace(F.to_json(F.expr(frame), {"ignoreNullFields": "false"}),
                         r'(individual_digits|add_prefix_space|use_regex)":"(true|false)"', '$1":$2').alias("value"))


def _hadoop_path(spark: SparkSession, path: str):
    """The file system and path object of a folder, whatever store it is in."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _put(spark: SparkSession, source: str, target: str) -> None:
    """Rename a file over another one, in one step."""
    jvm = spark._jvm
    options = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 1)
    options[0] = getattr(jvm.org.apache.hadoop.fs, "Options$Rename").OVERWRITE
    fs, to = _hadoop_path(spark, target)
    _, at = _hadoop_path(spark, source)
    to = fs.makeQualified(to)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(to.toUri(), spark._jsc.hadoopConfiguration())
    context.rename(fs.makeQualified(at), to, options)


def _write_one_file(df: DataFrame, folder: str, name: str) -> None:
    """The single row of ``df`` as one text file ``folder/name``, put in place whole."""
    spark = df.sparkSession
    part = f"{folder}/.{name}-{uuid.uuid4().hex}"
    df.coalesce(1).write.text(part)
    fs, at = _hadoop_path(spark, part)
    (written,) = [s.getPath() for s in fs.listStatus(at) if s.getPath().getName().startswith("part-")]
    _put(spark, written.toString(), f"{folder}/{name}")
    fs.delete(at, True)


def _digest(spark: SparkSession, file: str) -> str | None:
    """SHA-256 of a text file; ``None`` if it is empty or not there."""
    fs, p = _hadoop_path(spark, file)
    if not fs.exists(p):
        return None
    row = spark.read.text(file, wholetext=True).select(F.sha2("value", 256)).first()
    return row[0] if row else None


def write_tokenizer(spark: SparkSession, model: BpeModel, path: str, trained_on: str = "") -> None:
    """S3: write a new version beside the old ones and publish it by one rename. The
    version before stays for readers that are on it; older ones go."""
    path = path.rstrip("/")
    before = _manifest(spark, path)
    version = uuid.uuid4().hex
    folder = f"{path}/versions/{version}"
    vocab = model.vocab_df(spark).withColumn("repr", bytes_to_printable(F.col("bytes")))
    vocab.write.parquet(f"{folder}/vocab")
    model.merges_df(spark).write.parquet(f"{folder}/merges")
    config = spark.range(1).select(F.to_json(F.struct(
        F.lit("bpe").alias("model_type"), F.lit(model.vocab_size).alias("vocab_size"),
        F.lit(list(model.specials)).alias("special_tokens"), F.lit(trained_on).alias("trained_on"),
        F.current_timestamp().cast("string").alias("date"))).alias("value")).collect()[0]["value"]
    texts = {"tokenizer_config.json": spark.createDataFrame([(config,)], "value string"),
             "tokenizer.json": tokenizer_document(model, spark)}
    for name in FILES:
        _write_one_file(texts[name], folder, name)
    files = F.create_map(*[F.lit(x) for name in FILES for x in (name, _digest(spark, f"{folder}/{name}"))])
    manifest = spark.range(1).select(F.to_json(F.struct(F.lit(version).alias("version"), files.alias("files"))).alias("value"))
    _write_one_file(manifest, path, MANIFEST)          # from here on readers see the new model
    for name in FILES:
        copy = spark.read.text(f"{folder}/{name}", wholetext=True).select(F.regexp_replace("value", r"\n$", "").alias("value"))
        _write_one_file(copy, path, name)
    fs, versions = _hadoop_path(spark, f"{path}/versions")
    for old in fs.listStatus(versions):
        if old.getPath().getName() not in (version, before and before["version"]):
            fs.delete(old.getPath(), True)


def _manifest(spark: SparkSession, path: str):
    """The manifest row of a published folder, or ``None``."""
    file = f"{path.rstrip('/')}/{MANIFEST}"
    fs, p = _hadoop_path(spark, file)
    if not fs.exists(p):
        return None
    row = spark.read.schema(MANIFEST_SCHEMA).option("multiLine", "true").json(file).first()
    if not row or not row["version"]:
        raise ValueError(f"{file} is damaged")
    return row


def _file_of(spark: SparkSession, path: str) -> str:
    """The tokenizer file of a path: the path itself, that of the published version, or the plain one."""
    path = path.rstrip("/")
    if path.endswith(".json"):
        return path
    manifest = _manifest(spark, path)
    return f"{path}/tokenizer.json" if manifest is None else f"{path}/versions/{manifest['version']}/tokenizer.json"


def _check_version(spark: SparkSession, path: str) -> None:
    manifest = None if path.rstrip("/").endswith(".json") else _manifest(spark, path)
    if manifest:
        for name, digest in manifest["files"].items():
            if _digest(spark, f"{path.rstrip('/')}/versions/{manifest['version']}/{name}") != digest:
                raise ValueError(f"{name} of {path} is damaged: its digest is not that of the manifest")


def tokenizer_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _hadoop_path(spark, _file_of(spark, path))
    return fs.exists(p)


def _special_names(spark: SparkSession, src: str) -> list[str]:
    """The special tokens that the config beside the file lists; without one, all known names."""
    config = src.rsplit("/", 1)[0] + "/tokenizer_config.json"
    fs, p = _hadoop_path(spark, config)
    if fs.exists(p):
        row = spark.read.schema(CONFIG_SCHEMA).option("multiLine", "true").json(config).first()
        if row and row["special_tokens"]:
            return list(row["special_tokens"])
    return list(dict.fromkeys([*SPECIAL_TOKENS_19, *SPECIAL_TOKENS_25]))


def read_tokenizer_tables(spark: SparkSession, path: str,
                          known_specials: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """S4 as tables: ``(vocab (id, repr, bytes, kind), merges (rank, left, right, new_id))``.

    A special token (named by the caller, by the config file, or known) keeps
    its UTF-8 bytes; other entries are decoded from the printable form (falling
    back to UTF-8 when a character is outside it). A merge is kept only when
    ``r1``, ``r2`` and ``r1 + r2`` are all in the vocabulary; entries without a
    space are skipped. A missing file raises ``FileNotFoundError``, one without
    a readable vocabulary ``ValueError``.
    """
    src = _file_of(spark, path)
    if not tokenizer_exists(spark, src):
        raise FileNotFoundError(f"no tokenizer.json under {path}")
    _check_version(spark, path)
    known = list(known_specials or _special_names(spark, src))
    doc = spark.read.schema(TOKENIZER_SCHEMA).option("multiLine", "true").json(src)
    try:
        usable = doc.filter(F.size("model.vocab") > 0).take(1)
    except AnalysisException as e:
        raise ValueError(f"{src} cannot be read") from e
    if not usable:
        raise ValueError(f"{src} is damaged: it has no readable vocabulary")
    vocab = doc.select(F.explode("model.vocab").alias("repr", "id"))
    is_special = F.col("repr").isin(known)
    raw = F.when(is_special | ~is_printable_form("repr"), F.encode("repr", "UTF-8")) \
        .otherwise(printable_to_bytes("repr"))
    vocab = vocab.select("id", "repr", raw.alias("bytes"),
                         F.when(is_special, "special").otherwise("other").alias("kind"))
    merges = doc.select(F.posexplode("model.merges").alias("rank", "m")).filter(F.col("m").contains(" "))
    parts = F.split(F.col("m"), " ", 2)
    merges = merges.select("rank", parts[0].alias("r1"), parts[1].alias("r2"))
    v = vocab.select("repr", "id")
    # the vocabulary is bounded by the model size: broadcast lookups
    merges = (merges.join(F.broadcast(v.withColumnsRenamed({"repr": "r1", "id": "left"})), "r1")
              .join(F.broadcast(v.withColumnsRenamed({"repr": "r2", "id": "right"})), "r2")
              .withColumn("r12", F.concat("r1", "r2"))
              .join(F.broadcast(v.withColumnsRenamed({"repr": "r12", "id": "new_id"})), "r12")
              .select("rank", "left", "right", "new_id"))
    return vocab, merges


def read_tokenizer(spark: SparkSession, path: str, known_specials: list[str] | None = None) -> BpeModel:
    """Load a tokenizer file into a :class:`BpeModel` (bounded: vocab-size
    rows). Byte 0's printable form gives the byte offset; with ``<unk>`` and fewer than
    256 bytes the vocabulary has an alphabet."""
    vocab, merges = read_tokenizer_tables(spark, path, known_specials)
    rows = vocab.collect()
    specials = [r["repr"] for r in sorted((r for r in rows if r["kind"] == "special"), key=lambda r: r["id"])]
    single = sorted((r["id"], bytes(r["bytes"])[0]) for r in rows if r["kind"] != "special" and len(r["bytes"]) == 1)
    offset = next((i for i, b in single if b == 0), len(specials))
    alphabet = None
    if len(single) < 256 and UNKNOWN in specials:      # a vocabulary of the bytes of its corpus
        offset, alphabet = (single[0][0] if single else len(specials)), [b for _, b in single]
    pairs = sorted(merges.collect(), key=lambda r: r["rank"])
    return BpeModel(specials=specials, merges=[(r["left"], r["right"], r["new_id"], 0, 0) for r in pairs],
                    byte_offset=offset, extra_vocab={r["id"]: bytes(r["bytes"]) for r in rows}, alphabet=alphabet)
