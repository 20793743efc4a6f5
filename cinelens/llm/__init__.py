"""Training-data operators over text documents.

Each module holds one operator with its own interface (DataFrame in, DataFrame
out, column names as parameters); ``queries`` registers one thin query per
operator. Nothing outside this folder imports it.
"""
