from upkeep.plans.cli import main

main()
