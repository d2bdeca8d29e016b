"""Training-data operators: one module per operator, thin ``opN_<name>`` queries in ``queries``.

Nothing else in the library imports this subpackage; it imports only general session helpers.
"""
