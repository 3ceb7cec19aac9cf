"""etafeat: delivery-time feature engineering as lazy Spark DataFrame plans.

Every public function takes and returns DataFrames or Columns; nothing runs
until an action (write, gate, report) is called.
"""

__version__ = "0.1.0"
