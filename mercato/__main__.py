"""``python -m mercato <job> ...`` runs the job launcher (see ``mercato.cli``)."""

from .cli import main

main()
