"""Training-data operators over document tables.

Nothing else in the library imports this subpackage.  Each module holds one
operator; ``queries`` registers the thin queries over the driver's tables.
"""
