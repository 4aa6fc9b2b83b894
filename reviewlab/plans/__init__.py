"""The jobs: stages composed from operators, with tables between them."""
