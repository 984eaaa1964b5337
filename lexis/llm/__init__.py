"""Training-data operators: thirteen corpus jobs, each in a module of its own.

Nothing else in the library imports this subpackage. ``lexis.llm.registry``
lists the queries; ``corpus_pipeline.py`` at the repository top chains five
of the operators.
"""
