"""Tasks of one worker process share an encoder."""

from stintlab.llm.queries import tokenizer
from stintlab.llm.vocab import ByteEncoder, byte_encoder, load_file


def test_one_encoder_per_file():
    path = tokenizer("byte_bpe_50k.json")
    first = byte_encoder(load_file(path))
    ids = first.encode("kept from task to task")
    again = byte_encoder(load_file(path))
    assert again is first and "kept" in again.kept
    assert again.encode("kept from task to task") == ids == ByteEncoder(load_file(path)).encode("kept from task to task")
