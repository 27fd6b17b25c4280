"""Operators for preparing language-model training text.

Nothing else in the library imports this subpackage. Functions that run in
Python workers are sent by value, so executors need no copy of the code.
"""

from pyspark import cloudpickle

import vigil.llm as _self

cloudpickle.register_pickle_by_value(_self)
