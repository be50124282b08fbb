import pytest

from rowsieve.llm.common import ship


@pytest.fixture(scope="session", autouse=True)
def workers(spark):
    """The workers have this code."""
    ship(spark)


@pytest.fixture(scope="session")
def tokenizer():
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")
