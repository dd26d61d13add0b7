"""From a corpus to a vocabulary, and from texts or chats to sharded samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.encode import encode_chats, encode_documents, encoder
from ..operators.feed import shard_rows
from ..operators.order import block_sequence, position
from ..operators.sinks import write_shards
from ..operators.vocab import Vocabulary, pretoken_freq, save_vocabulary, train_bpe
from ..sources.samples import chat_samples, pretrain_samples, tokenizer_texts
from ..workspace import spread, stage, staging

SAMPLE_BLOCK = ["file_class", "file_parts", "blk"]


def train_tokenizer(
    spark: SparkSession, data_dir: str, out_dir: str, vocab_size: int = 12_000, min_frequency: int = 2
) -> Vocabulary:
    """Train on the text files of a folder and save the vocabulary."""
    vocab = train_bpe(pretoken_freq(spread(tokenizer_texts(spark, data_dir))), vocab_size, min_frequency)
    save_vocabulary(spark, vocab, out_dir)
    return vocab


def _feed(encoded: DataFrame, out_path: str, ranks: int, epochs: int, seed: int) -> None:
    """Number the samples in reading order, shuffle per epoch, deal to ranks and write.

    Numbers, ranks and places are found on narrow rows; the encoded arrays meet them in one join.
    """
    with staging(encoded.sparkSession):
        samples = stage(encoded, "encoded")
        narrow = block_sequence(samples.select(*SAMPLE_BLOCK, "pos"), SAMPLE_BLOCK, "pos")
        # Within a block numbers are dense up to lines left out, so a block and a range of positions
        # bound a bucket.
        ids = position(
            narrow.select("seq"), "row", [F.shiftright("seq", 16)], [F.col("seq")]
        )
        shards = stage(shard_rows(ids.select("row"), "row", ranks, epochs, seed), "shards")
        places = (shards.agg(F.max("place")).first()[0] or 0) + 1
        placed = shards.join(ids, "row").join(narrow, "seq").select(*SAMPLE_BLOCK, "pos", "epoch", "rank", "place", "row")
        rows = samples.join(placed, [*SAMPLE_BLOCK, "pos"])
        write_shards(rows.select("epoch", "rank", "place", "row", "input_ids", "labels"), out_path, epochs, ranks, places)


def pretrain_feed(
    spark: SparkSession, data_path: str, vocab: Vocabulary, out_path: str,
    length: int = 512, ranks: int = 1, epochs: int = 1, seed: int = 42,
) -> None:
    """Encoded, shuffled and sharded samples of a corpus."""
    texts = pretrain_samples(spark, data_path)
    _feed(encode_documents(texts, encoder(spark, vocab), length), out_path, ranks, epochs, seed)


def sft_feed(
    spark: SparkSession, data_path: str, vocab: Vocabulary, out_path: str,
    length: int = 512, ranks: int = 1, epochs: int = 1, seed: int = 42,
) -> None:
    """Encoded, shuffled and sharded samples of a chat file."""
    chats = chat_samples(spark, data_path)
    _feed(encode_chats(chats, encoder(spark, vocab), length), out_path, ranks, epochs, seed)
