"""Training-data operators: each module holds one operator with a general interface.

Nothing else in the library imports this subpackage; ``llm.queries`` binds the operators to the
synthetic tables as thin ``opN_<name>`` queries.
"""
