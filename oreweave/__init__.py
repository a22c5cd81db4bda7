"""oreweave: a Spark-first engine for fusing scattered mineral-deposit data.

Everything is expressed on DataFrames.  The core (sources, functions,
operators, plans, streaming) does not import the optional ``llm`` subpackage.
"""

__version__ = "0.2.0"

#: Verbs of the package, loaded when they are first asked for.
__all__ = ["enrich", "fuse", "ingest_delimited", "ingest_documents", "run_enrich", "run_fusion", "run_ingest"]


def __getattr__(name: str):
    if name in __all__:
        from oreweave.plans import pipelines

        return getattr(pipelines, name)
    raise AttributeError(name)
