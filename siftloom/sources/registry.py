"""The configured sources."""

from collections.abc import Iterable
from dataclasses import asdict, dataclass, replace

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Source:
    """One table to read: where it is, which adapter reads it, and its defaults."""

    id: str
    name: str
    hf_name: str
    description: str
    split: str = "train"
    streaming: bool = False
    adapter: str = ""
    language: str | None = None
    license: str | None = None
    enabled: bool = True
    config: str | None = None
    path: str | None = None
    order_by: str | None = None
    # of JSON files: a record per line, or one "array" per file
    layout: str = "lines"

    @property
    def source_url(self) -> str:
        return f"https://huggingface.co/datasets/{self.hf_name}"

    def at(self, path: str, **changes) -> "Source":
        return replace(self, path=path, **changes)

    def info(self) -> dict:
        return {"name": self.adapter or self.id, "hf_name": self.hf_name,
                "description": self.description, "source_url": self.source_url}


# fixed values: the public datasets, in the order in which they are merged
DEFAULT_SOURCES = (
    Source("mbpp", "MBPP", "google-research-datasets/mbpp",
           "Mostly Basic Programming Problems", "train", adapter="mbpp",
           language="python", license="cc-by-4.0"),
    Source("apps", "APPS", "codeparrot/apps",
           "Automated Problem-solving Programming set", "train", adapter="apps",
           language="python", license="mit"),
    Source("humaneval", "HumanEval", "openai/openai_humaneval",
           "Code generation benchmark", "test", adapter="humaneval",
           language="python", license="mit"),
    Source("codealpaca", "CodeAlpaca", "sahil2801/CodeAlpaca-20k",
           "Code instruction tuning dataset", "train", adapter="codealpaca",
           license="cc-by-4.0"),
    Source("evolcode", "EvolCode", "nickrosh/Evol-Instruct-Code-80k-v1",
           "Evolved code dataset", "train", adapter="evolcode",
           language="python", license="cc-by-nc-sa-4.0"),
    Source("taco", "TACO", "BAAI/TACO",
           "Test-Aimed Code Object", "train", adapter="taco",
           language="python", license="apache-2.0"),
)


def select_sources(sources: Iterable[Source] = DEFAULT_SOURCES, enabled: Iterable[str] = (),
                   disabled: Iterable[str] = ()) -> list[Source]:
    """Sources to read: the named ones if any are named, minus the disabled."""
    only, never = set(enabled), set(disabled)
    return [s for s in sources
            if s.enabled and s.id not in never and (not only or s.id in only)]


def registry_frame(spark: SparkSession, sources: Iterable[Source] = DEFAULT_SOURCES) -> DataFrame:
    """The registry as a table, with the position of each source."""
    rows = [{"dataset_ord": i, **asdict(s), "source_url": s.source_url}
            for i, s in enumerate(sources)]
    return spark.createDataFrame(
        rows, "dataset_ord int, id string, name string, hf_name string, description string,"
              " split string, streaming boolean, adapter string, language string,"
              " license string, enabled boolean, config string, path string,"
              " order_by string, layout string, source_url string")


def source_summary(registry: DataFrame) -> DataFrame:
    return registry.select("id", "name", "hf_name", "split", "streaming", "adapter",
                           "description", "source_url")
