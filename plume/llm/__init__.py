"""Training-data operators: ten operators on documents and pages, and the
queries that apply them (``registry``). Nothing else in the library imports
this package."""
